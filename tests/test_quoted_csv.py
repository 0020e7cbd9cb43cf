"""CSV files with line breaks in quoted fields, cut into splits of a few bytes."""

import csv
import io
import random

import pytest

from linkloom.sources.quoted_csv import read_positional


def _read(spark, path, columns=("a", "b")):
    return sorted((r.file, *[r[c] for c in columns]) for r in read_positional(spark, str(path), list(columns)).collect())


def _whole(spark, path, columns=("a", "b")):
    """Spark's own reader, a task a file."""
    from pyspark.sql import functions as F

    options = dict(header=True, enforceSchema=True, quote='"', escape='"', multiLine=True)
    df = spark.read.schema(", ".join(f"{c} string" for c in columns)).options(**options).csv(str(path))
    return sorted(((r.file, *[r[c] for c in columns]) for r in df.withColumn("file", F.url_decode(F.substring_index(F.input_file_name(), "/", -1))).collect()))


def _field(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choice('a"\n,\r\n') for _ in range(rng.randint(0, 12)))
    if kind < 0.4:
        return "\n".join("x" * rng.randint(0, 30) for _ in range(rng.randint(1, 8)))
    return f"GSE{rng.randint(0, 999)}"


@pytest.mark.parametrize("size", ["16", "64", "1000"])
def test_any_split_gives_the_records_that_were_written(spark, tmp_path, conf, size):
    conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0", spark__sql__shuffle__partitions="3")
    want = []
    for name in ("one.x.csv", "two words.csv"):
        rng, text = random.Random(name + size), io.StringIO()
        out = csv.writer(text, lineterminator=rng.choice(["\n", "\r\n"]))
        out.writerow(["head\nline" if name[0] == "o" else "head", "b"])
        for _ in range(60):
            row = [_field(rng) or "e", _field(rng) or "e"]
            out.writerow(row)
            want.append((name, *row))
        (tmp_path / name).write_text(text.getvalue(), newline="")
    assert _read(spark, tmp_path) == sorted(want)


def test_stray_quotes_missing_and_further_fields(spark, tmp_path, conf):
    """A quote within an unquoted field opens nothing; blank lines are no records."""
    conf(spark__sql__files__maxPartitionBytes="20", spark__sql__files__openCostInBytes="0", spark__sql__shuffle__partitions="3")
    lines = ["a,b", '5" pipe,PMC1', "alone", "x,y,z", "", '"q","say ""hi"""', 'p"q"r,PMC2', '"two', 'lines",PMC3', "last,PMC4"]
    (tmp_path / "f.csv").write_text("\n".join(lines))
    got = _read(spark, tmp_path)
    assert [r for r in got if r[1] != "alone"] == [r for r in _whole(spark, tmp_path) if r[1] != "alone"]
    assert ("f.csv", "two\nlines", "PMC3") in got and ("f.csv", '5" pipe', "PMC1") in got and ("f.csv", "alone", None) in got


def test_a_quote_that_is_never_closed_costs_its_own_line(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\nx,1\n"open,2\ny,3\n')
    got = [r[1] for r in _read(spark, tmp_path)]
    assert "x" in got and "y" in got and len(got) == 3


def test_empty_files_and_headers_alone(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("a,b\n")
    assert _read(spark, tmp_path) == []
