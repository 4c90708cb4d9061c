import pytest
from pyspark.errors import StreamingQueryException

from silvermill.plans.pipeline import silver_table
from silvermill.sources import SEQ
from silvermill.streaming import ingest_by_name
from silvermill.streaming.named import NamedPartsReader
from tests.conftest import rows
from tests.test_pipeline import PAIR, PAIR_SCHEMA, write_pairs


class Recorded:
    """A table that notes the parts of each batch, and may fail once."""

    def __init__(self, table):
        self.table, self.batches, self.fail_at = table, [], None

    def apply(self, rows_in, **options):
        self.batches.append(sorted(r[0] for r in rows_in.select(SEQ).distinct().collect()))
        if len(self.batches) == self.fail_at:
            raise RuntimeError("lost")
        return self.table.apply(rows_in, **options)


def part(time, key=1):
    return f"20240101-{time}", [(key, f'[{{"id":1,"name":"{time}"}}]')]


def test_parts_are_admitted_by_name_once_and_late_ones_too(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    table = Recorded(silver_table(spark, str(tmp_path / "silver"), PAIR, slices=2))

    def ingest(per_trigger):
        table.batches.clear()
        ingest_by_name(spark, PAIR, bronze, table, str(tmp_path / "ckpt"), PAIR_SCHEMA, per_trigger)
        return [[seq % 1_000_000 for seq in batch] for batch in table.batches]

    for time in ("222937", "080000", "105003"):
        write_pairs(spark, bronze, *part(time))
    assert ingest(1) == [[80000], [105003], [222937]]
    assert rows(table.table.read()) == [("1", 1, "222937")]
    assert ingest(1) == []
    write_pairs(spark, bronze, *part("230000", 2))
    write_pairs(spark, bronze, *part("090000"))
    assert ingest(0) == [[90000, 230000]]
    assert rows(table.table.read()) == [("1", 1, "222937"), ("2", 1, "230000")]


def test_a_failed_batch_is_run_again_with_the_same_parts(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    table = Recorded(silver_table(spark, str(tmp_path / "silver"), PAIR, slices=2))
    ingest = lambda: ingest_by_name(
        spark, PAIR, bronze, table, str(tmp_path / "ckpt"), PAIR_SCHEMA, 1
    )
    for time in ("100000", "120000"):
        write_pairs(spark, bronze, *part(time))
    table.fail_at = 2
    with pytest.raises(StreamingQueryException):
        ingest()
    write_pairs(spark, bronze, *part("110000"))  # lands before the batch is tried again
    ingest()
    assert [[seq % 1_000_000 for seq in b] for b in table.batches] == [[100000], [120000], [120000], [110000]]
    assert rows(table.table.read()) == [("1", 1, "120000")]


def test_names_of_parts(tmp_path):
    folder = tmp_path / "pairs"
    reader = NamedPartsReader(f"file:{folder}", "pairs")
    assert list(reader.read(reader.initialOffset())[0]) == []
    folder.mkdir()
    for name in ("pairs_part_20240101-000001.parquet", "pairs_part_x.parquet", "other_part_20240101-000001.parquet"):
        (folder / name).touch()
    found, offset = reader.read(reader.initialOffset())
    assert list(found) == [("pairs_part_20240101-000001.parquet",)]
    assert list(reader.readBetweenOffsets(reader.initialOffset(), offset)) == [("pairs_part_20240101-000001.parquet",)]
    assert reader.read(offset)[1] == offset
    with pytest.raises(ValueError):
        NamedPartsReader("x", "pairs", -1)
