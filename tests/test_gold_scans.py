"""What the gold queries write on the way."""

from registry import layers
from tristrata.sources import scratch


def test_the_wide_table_is_not_written_for_the_star(spark, small, monkeypatch):
    """Writing its attributes took a fifth of the run; the numbered flights and the lookup tables are enough."""
    written = {}
    stored = scratch.table

    def table(df, label="table"):
        written[label] = df.columns
        return stored(df, label)

    monkeypatch.setattr(scratch, "table", table)
    layers.fact_keys(spark, small)
    assert {"flights", "airlines", "airports", "key-flight_id"} <= set(written)
    assert not any("origin_airport_name" in columns for columns in written.values())
