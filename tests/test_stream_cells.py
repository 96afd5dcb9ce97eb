import pytest
from pyspark.errors import StreamingQueryException

from trendmark.schemas import CSV_FILE
from trendmark.streaming import stream_csv_snapshots

NAMES = CSV_FILE.fieldNames()


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def landed(spark, folder, path, **options):
    stream = stream_csv_snapshots(spark, str(path), **options)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("_arrived_at")


def test_files_in_the_expected_order_are_read_as_that_many_cells(spark, tmp_path):
    """Each cell that a row lacks costs an error, so no row is read as up to 64."""
    put(tmp_path / "raw", "a.csv", ",".join(NAMES) + "\n")
    plan = stream_csv_snapshots(spark, str(tmp_path / "raw"))._jdf.queryExecution().analyzed().toString()
    read = [line for line in plan.split("\n") if "StreamingRelation" in line]
    assert len(read) == 1 and f"c{len(NAMES) - 1}#" in read[0] and f"c{len(NAMES)}#" not in read[0]


@pytest.mark.parametrize("more", [0, 1, 4, 5, 16, 17, 47])
def test_cells_of_wide_files_are_found_wherever_they_stand(spark, tmp_path, more):
    """Quotes, line breaks and commas in cells, empty cells, rows cut short and columns beyond the expected ones."""
    names = [f"extra{i}" for i in range(more)] + NAMES[::-1]
    whole = [f'"{n} of 1, ""quoted""\nnext line"' for n in names]
    rows = [",".join(whole), ",".join("" if i % 2 else f"{n}2" for i, n in enumerate(names)), ",".join(f"{n}3" for n in names[:-3])]
    put(tmp_path / "raw" / "region=x", "a.csv", ",".join(names) + "\n" + "\n".join(rows * 50) + "\n")
    found = [tuple(r) for r in landed(spark, tmp_path, tmp_path / "raw").select(*NAMES).collect()]
    want = [
        {n: f'{n} of 1, "quoted"\nnext line' for n in names},
        {n: None if i % 2 else f"{n}2" for i, n in enumerate(names)},
        {n: f"{n}3" for n in names[:-3]},
    ]
    assert sorted(found, key=str) == sorted([tuple(w.get(n) for n in NAMES) for w in want] * 50, key=str)


def test_files_without_a_known_name_and_one_too_wide(spark, tmp_path):
    put(tmp_path / "raw", "a.csv", "one,two\n1,2\n3,4\n")
    put(tmp_path / "raw", "b.csv", "\n".join([",".join(NAMES), ",".join(NAMES), ",".join("x" for _ in NAMES)]) + "\n")
    found = [tuple(r) for r in landed(spark, tmp_path, tmp_path / "raw").select(*NAMES).collect()]
    empty = (None,) * len(NAMES)
    assert sorted(found, key=str) == sorted([empty, empty, tuple(NAMES), ("x",) * len(NAMES)], key=str)
    put(tmp_path / "wide", "c.csv", ",".join(f"n{i}" for i in range(70)) + "\n" + ",".join("1" * 70) + "\n")
    with pytest.raises(StreamingQueryException, match="more than 64 columns"):
        landed(spark, tmp_path / "second", tmp_path / "wide")
