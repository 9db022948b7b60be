"""Every query of the subpackage runs on the smallest tables and has the columns it has to have."""

import os

import duckdb
import pytest

from rallybase.llm import catalog

COLUMNS = {
    "p2_found": ["transition_row_id", "player_id_ext"], "p3_found": ["player_id", "survivor_player_id"], "p4_found": ["table_name", "field_name", "row_id", "entity_key"], "p7_found": ["row_id_a", "row_id_b"], "p8_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, small, name):
    out = catalog.queries()[name](spark, small)
    rows = out.collect()
    if name in COLUMNS:
        assert out.columns == COLUMNS[name]
        assert len(rows) == len(set(rows))
    if name in catalog.oracle_sql():
        c = duckdb.connect()
        for f in os.listdir(small):
            c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{small}/{f}'")
        assert sorted(map(tuple, rows)) == sorted(c.execute(catalog.oracle_sql()[name]).fetchall())
