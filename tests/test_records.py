"""The record scan against a whole-file CSV parse, at several split sizes."""

import csv
import os
import random

import pytest

from stratum.sources import inventory
from stratum.sources.orders import read_order_csv, read_order_csv_quarantined
from stratum.sources.records import csv_record_count, csv_records

SPLITS = (64, 1000, 10_000_000)


@pytest.fixture()
def split_size(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(n):
        spark.conf.set(keys[0], n)
        spark.conf.set(keys[1], 1)

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def random_files(folder, seed, spanning, line_end="\n"):
    """Files with quotes, blank lines and, in some, line feeds inside fields."""
    rng = random.Random(seed)
    os.makedirs(folder)
    for f in range(4):
        with open(os.path.join(folder, f"part-{f}.csv"), "w", newline="", encoding="utf-8") as out:
            w = csv.writer(out, lineterminator=line_end)
            w.writerow(["id", "text", "n"])
            for i in range(rng.randrange(60) if f != 2 else 0):
                text = rng.choice(["plain", 'a "quoted" word', "with, comma", "", "été"])
                if spanning and f != 1 and rng.random() < 0.2:
                    text = rng.choice(["two\nlines", 'say "a\n"\n\n , b', "\n", "x\n" * 12 + '"'])
                w.writerow([f"{f}-{i}", text, i])
                if rng.random() < 0.1:
                    out.write(line_end)
    return folder


def whole_parse(folder):
    rows = []
    for name in sorted(os.listdir(folder)):
        with open(os.path.join(folder, name), newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    return rows


@pytest.mark.parametrize("spanning", [False, True])
def test_records_equal_a_whole_parse(spark, scratch, split_size, spanning):
    folder = random_files(os.path.join(scratch, "in"), 5, spanning)
    want = whole_parse(folder)
    assert spanning == any("\n" in r["text"] for r in want)
    for n in SPLITS:
        split_size(n)
        rows = csv_records(spark, folder).orderBy("file", "record_no").collect()
        assert sum(r.record_no == -1 for r in rows) == 4
        data = [r for r in rows if r.record_no >= 0]
        assert [r.source_rank for r in data] == list(range(len(want)))
        assert [next(csv.reader([*r.record.splitlines(keepends=True)])) for r in data] == [list(w.values()) for w in want]
        assert csv_record_count(spark, folder).first().n == len(want)


def test_carriage_returns_and_marks(spark, scratch, split_size):
    p = os.path.join(scratch, "crlf.csv")
    with open(p, "w", newline="", encoding="utf-8") as f:
        f.write('﻿a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    for n in SPLITS:
        split_size(n)
        rows = csv_records(spark, p).orderBy("record_no").collect()
        assert [(r.record_no, r.record) for r in rows] == [(-1, "a,b"), (0, '1,"x\r\ny"'), (1, "2,z")]


def test_empty_and_header_only_files(spark, scratch):
    folder = os.path.join(scratch, "few")
    os.makedirs(folder)
    for name, text in (("a.csv", ""), ("b.csv", "x,y\n"), ("c.csv", "x,y\n1,2\n"), ("d.csv", "\n\nx,y\n\n3,4")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    rows = csv_records(spark, folder).filter("record_no >= 0").orderBy("source_rank").collect()
    assert [(r.source_rank, r.record) for r in rows] == [(0, "1,2"), (1, "3,4")]
    assert inventory.file_rows(spark, folder) == 2
    assert inventory.file_rows(spark, os.path.join(folder, "a.csv")) == 0
    assert inventory.csv_preview(spark, os.path.join(folder, "a.csv")) == []


def test_quotes_that_never_close_stop_the_run(spark, scratch):
    p = os.path.join(scratch, "open.csv")
    with open(p, "w") as f:
        f.write('a,b\n1,"open\n' + "x,y\n" * 1000)
    with pytest.raises(Exception, match="quotes may not close"):
        csv_records(spark, p, max_chars=500).collect()
    assert csv_records(spark, p).count() == 2


def test_orders_keep_their_rank_at_every_split(spark, scratch, split_size):
    p = os.path.join(scratch, "orders.csv")
    with open(p, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["order_id", "customer_id", "region", "channel", "status", "amount", "currency", "order_ts"])
        for i in range(200):
            channel = 'desk "3"\nfloor 2' if i % 7 == 0 else "web"
            w.writerow([f"O{i % 50}", "C", "R", channel, "completed", "bad" if i == 9 else i, "USD", "2026-03-14T09:00:00Z"])
    for n in SPLITS:
        split_size(n)
        rows = read_order_csv(spark, p, strict_amount=False).orderBy("source_rank").collect()
        assert [(r.source_rank, r.order_id) for r in rows] == [(i, f"O{i % 50}") for i in range(200)]
        assert rows[7].channel == 'desk "3"\nfloor 2'
        good, bad = read_order_csv_quarantined(spark, p)
        assert sorted(r.source_rank for r in good.collect()) == [i for i in range(200) if i != 9]
        assert bad.count() == 1


def test_preview_of_records(spark, scratch):
    p = os.path.join(scratch, "prev.csv")
    with open(p, "w") as f:
        f.write('id,text,"odd, ""name"""\n1,"a\nb",\n2,c,d\n3,e,f\n')
    assert inventory.csv_preview(spark, p, 2) == [{"id": "1", "text": "a\nb"}, {"id": "2", "text": "c", 'odd, "name"': "d"}]


def test_lines_are_not_sorted(spark, scratch):
    """A split's lines are cut while they are read: nothing orders or shuffles them."""
    folder = random_files(os.path.join(scratch, "plan"), 3, True)
    for df in (csv_records(spark, folder), csv_record_count(spark, folder)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "monotonically_increasing_id" not in plan
        assert not [x for x in plan.splitlines() if "Window" in x and "value#" in x]


def test_bytes_that_are_no_utf8_do_not_stop_the_scan(spark, scratch, split_size):
    p = os.path.join(scratch, "raw.csv")
    with open(p, "wb") as f:
        f.write(b'a,b\n\xff1,x\n2,"\xfe\ny"\n')
    for n in SPLITS:
        split_size(n)
        rows = csv_records(spark, p).orderBy("record_no").collect()
        assert [r.record for r in rows] == ["a,b", "\ufffd1,x", '2,"\ufffd\ny"']
