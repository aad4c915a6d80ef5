"""Tables for point lookups: clustered by what is looked up, so that statistics and Bloom filters spare the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Bytes of a row group: what a lookup reads at least, before pages are left out.
GROUP_BYTES = 16 << 20


def write_clustered(rows: DataFrame, path: str, by: Sequence[str], looked_up: Sequence[str] = (), group_bytes: int = GROUP_BYTES) -> None:
    """Write rows in ranges of ``by``, sorted, so that each row group has a narrow range; later columns of ``by`` cut a hot value.

    Columns in ``looked_up`` get Bloom filters, for equality where ranges don't help.
    """
    writer = rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").option("parquet.block.size", group_bytes)
    for c in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
