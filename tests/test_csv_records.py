"""Records with quoted line ends: the parallel reader against Spark's own."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import types as T

from ordermill.sources.csv_load import load_csv, read_csv
from ordermill.sources.csv_records import _lines, csv_records

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("qty", T.LongType())])
SPLIT = "spark.sql.files.maxPartitionBytes"
COST = "spark.sql.files.openCostInBytes"


@pytest.fixture()
def small_splits(spark):
    spark.conf.set(SPLIT, "60b")
    spark.conf.set(COST, "1b")
    yield
    spark.conf.unset(SPLIT)
    spark.conf.unset(COST)


def _write(tmp, name, text):
    path = os.path.join(tmp, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def _rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def _same_as_one_task(spark, path):
    parts = load_csv(spark, path, SCHEMA)
    whole = load_csv_one_task(spark, path)
    assert _rows(parts.good) == _rows(whole.good)
    assert _rows(parts.rejected) == _rows(whole.rejected)
    return parts


def load_csv_one_task(spark, path):
    from pyspark.sql import functions as F
    from ordermill.sources import csv_load
    parsed = read_csv(spark, path, SCHEMA, multi_line=True).cache()
    ok = F.col(csv_load.CORRUPT).isNull()
    names = csv_load._restore_empty(SCHEMA)
    return csv_load.CsvLoad(parsed.where(ok).select(*names),
                            parsed.where(~ok).select(*names, F.col(csv_load.CORRUPT)))


FIELDS = ["plain", '"quoted"', '"with, comma"', '"two\nlines"', '"a\n\nb"', '"doubled "" quote"', '""', "", '"""x"""',
          'stray " quote', 'in"side', '"ends, \n ""in"" \n three"', "é☺", '"\n"', '"",""'.replace('"",""', '""""')]


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_same_rows_as_the_reader_in_one_task(spark, tmp, small_splits, seed, end):
    rng = random.Random(seed)
    rows = []
    for k in range(300):
        row = [str(k), rng.choice(FIELDS), str(k % 7)]
        kind = rng.random()
        if kind < 0.05:
            row = row[:2]
        elif kind < 0.1:
            row.append("extra")
        elif kind < 0.15:
            row[2] = "many"
        rows.append(",".join(row))
    path = _write(tmp, "a.csv", end.join(["﻿id,name,qty", *rows]) + (end if seed != 2 else ""))
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    _same_as_one_task(spark, path)


def test_fields_longer_than_many_splits_and_headers_of_each_file(spark, tmp, small_splits):
    long = "\n".join(f"line {k}, with ""comma" for k in range(60))
    folder = os.path.join(tmp, "parts")
    os.makedirs(folder)
    _write(folder, "a.csv", f'id,name,qty\n1,"{long}",2\n3,x,4\n')
    _write(folder, "b.csv", 'id,"na\nme",qty\n5,"y\nz",6\n')
    parts = load_csv(spark, folder, SCHEMA)
    assert {(r["id"], r["name"], r["qty"]) for r in parts.good.collect()} == {(1, long, 2), (3, "x", 4), (5, "y\nz", 6)}
    assert parts.rejected.count() == 0


def test_a_quote_that_is_never_closed(spark, tmp, small_splits):
    text = "id,name,qty\n1,a,1\n" + '2,"open,2\n' + "".join(f"{k},b,1\n" for k in range(3, 60))
    path = _write(tmp, "a.csv", text)
    parts = load_csv(spark, path, SCHEMA)
    assert [r["id"] for r in parts.good.collect()] == [1]
    bad = parts.rejected.collect()                     # as the reader in one task has it
    assert [r["id"] for r in bad] == [2] and bad[0]["name"].startswith("open,2\n3,b,1\n4,b")
    apart = csv_records(spark, path, most_lines=10).collect()
    assert len(apart) == 59                            # nothing is lost, nothing is put together
    empty = _write(tmp, "empty.csv", "id,name,qty\n")
    assert csv_records(spark, empty).count() == 0


def test_lines_are_read_in_many_tasks(spark, tmp, small_splits):
    path = _write(tmp, "a.csv", "id,name,qty\n" + "".join(f'{k},"a\nb",1\n' for k in range(200)))
    lines = _lines(spark, path)
    assert lines.select("block").distinct().count() > 20
    assert load_csv(spark, path, SCHEMA).good.count() == 200
