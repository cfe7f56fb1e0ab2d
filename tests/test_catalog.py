"""Registry consistency: every query has a normalised spec and an oracle."""

import __spark_entry__ as E
from tierforge.plans import catalog
from tierforge.plans.specs import SPECS


def test_every_query_has_spec_and_oracle():
    q, sql = catalog.queries(), catalog.oracle_sql()
    assert set(q) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
    assert set(q) == set(SPECS)
    assert set(q) == set(sql)
    for name, text in sql.items():
        cols = [c for c, _ in SPECS[name]]
        assert len(cols) == len(set(cols)), name
        assert all(f" as {c}" in text for c in cols), name
    assert sum(n.startswith("m") and n[1:3].isdigit() for n in q) == 37
