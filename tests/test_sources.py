"""Tolerant readers, file facts and the ledger on hand-made files."""

import gzip
import hashlib
import json
import random

import pytest


from ordergate import table
from ordergate.session import local_frame
from ordergate.sources import csv_files, csv_records, files, json_files, json_records
from ordergate.sources.ledger import LEDGER_SCHEMA, ledger_rows, list_processed, mark_done, status_of

REGION, CATEGORY, CITY = table("regions"), table("categories"), table("cities")
HEAD = "region_id,region_name,city_id,delivery_base_fee\n"


def facts(spark, folder):
    return files.fingerprint(spark, files.list_files(spark, str(folder))).collect()


def read(spark, folder, spec):
    return [tuple(r)[2:] for r in csv_files.read_csv(spark, facts(spark, folder), spec).orderBy("_file", "_order").collect()]


def test_long_lines_skipped_short_lines_padded(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        HEAD + "1,a,1,5\n2,b\n3,c,1,5,surplus\n4,d,1,5,\n5,e,1,5,,x\n\n6,\"f,g\",1,\"5\"\n7,\"h,,,,i\",1\n8,N/A,1,\n")
    assert read(spark, tmp_path, REGION) == [
        ("1", "a", "1", "5"), ("2", "b", None, None), ("6", "f,g", "1", "5"), ("7", "h,,,,i", "1", None),
        ("8", None, "1", None)]


def test_quoted_newline_stays_in_its_field(spark, tmp_path):
    (tmp_path / "c.csv").write_text('category_id,category_name\n1,"two\nlines"\n2,"say ""hi"""\n')
    assert read(spark, tmp_path, CATEGORY) == [("1", "two\nlines"), ("2", 'say "hi"')]


def test_encodings_and_column_order(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes("category_id,category_name\n1,café\n".encode("latin-1"))
    (tmp_path / "2.csv").write_bytes("﻿note,category_name,category_id\nx,thé,2\n".encode())
    assert read(spark, tmp_path, CATEGORY) == [("1", "café"), ("2", "thé")]


def test_missing_columns_and_empty_files(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("category_id\n1\n")
    (tmp_path / "zero.csv").write_text("")
    (tmp_path / "head.csv").write_text("category_id,category_name\n")
    assert read(spark, tmp_path, CATEGORY) == []
    by_name = {f.path.rsplit("/", 1)[1]: f for f in facts(spark, tmp_path)}
    assert set(by_name) == {"bad.csv", "zero.csv", "head.csv"}
    assert csv_files.missing_columns(by_name["bad.csv"].header, CATEGORY) == ["category_name"]
    assert by_name["zero.csv"].length == 0 and by_name["zero.csv"].md5 == hashlib.md5(b"").hexdigest()


def test_gzipped_files_have_the_facts_and_rows_of_plain_ones(spark, tmp_path):
    texts = {"utf8": "\n \ncategory_id,category_name\n1,caf\u00e9\n2,\"a,b\"\n".encode(), "latin": "category_id,category_name\n3,caf\u00e9\n".encode("latin-1"),
             "plain": b"\xef\xbb\xbfcategory_id,category_name\n4,x\n5,N/A\n", "lines": b'category_id,category_name\n6,"two\nlines"\n', "blank": b"\n"}
    for name, text in texts.items():
        for kind, write in (("a", bytes), ("z", gzip.compress)):
            (tmp_path / kind).mkdir(exist_ok=True)
            (tmp_path / kind / f"{name}.csv{'.gz' if kind == 'z' else ''}").write_bytes(write(text))
    told = {kind: {f.path.rsplit("/", 1)[1].split(".")[0]: (f.is_utf8, f.header, f.has_quotes) for f in facts(spark, tmp_path / kind)} for kind in "az"}
    assert told["a"] == told["z"] and len(told["z"]) == 5
    packed = {f.path.rsplit("/", 1)[1].split(".")[0]: f.md5 for f in facts(spark, tmp_path / "z")}
    assert packed == {name: hashlib.md5((tmp_path / "z" / f"{name}.csv.gz").read_bytes()).hexdigest() for name in texts}
    rows = read(spark, tmp_path / "z", CATEGORY)
    assert rows == read(spark, tmp_path / "a", CATEGORY) and ("1", "caf\u00e9") in rows and ("6", "two\nlines") in rows


def test_gzipped_json(spark, tmp_path):
    members = [{"city_id": i, "city_name": f"c{i}", "country": None, "timezone": "x"} for i in range(3)]
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(json.dumps(members).encode()))
    for split_from in (None, 0):
        rows = json_files.read_json(spark, facts(spark, tmp_path), CITY, split_from=split_from)
        assert sorted(r.city_id for r in rows.collect()) == ["0", "1", "2"]


def test_delivered_files_are_cut_within_their_slot(spark, tmp_path, monkeypatch):
    """Forty rows in four slots, at most ten a file: four gzipped files, not sixteen."""
    from checks import files as delivered
    monkeypatch.setattr(delivered, "ROWS_PER_FILE", 10)
    rows = spark.range(40).selectExpr(
        "cast(id as string) category_id", "concat('n', id) category_name", "id as _order", "lpad(cast(id % 4 as string), 2, '0') slot")
    delivered.write_table(rows, "categories", "csv", "categories.csv", str(tmp_path), "2024-01-01")
    found = facts(spark, tmp_path)
    assert len(found) == 4 and all(f.path.endswith(".gz") for f in found)
    back = csv_files.read_csv(spark, found, CATEGORY).select("category_id", "category_name").collect()
    assert sorted(map(tuple, back)) == sorted((str(i), f"n{i}") for i in range(40))


def test_missing_folder_is_no_error(spark, tmp_path):
    assert files.list_files(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("split", [False, True])
def test_json_shapes(spark, tmp_path, monkeypatch, split):
    if split:
        monkeypatch.setattr(json_files, "SPLIT_FROM", 0)
    whole = '{"city_id": 1, "city_name": "N/A", "country": null, "timezone": NaN}'
    cases = {
        "list": f"[{whole}, {{\"city_id\": 2.0}}]", "bare": whole, "empty": "[]", "scalar": "5",
        "broken": '[{"city_id": 1', "scalars": "[1, 2]", "lacking": '[{"city_id": 1}]'}
    for name, text in cases.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = files.list_files(spark, str(tmp_path)).collect()
    rows = json_files.read_json(spark, found, CITY).orderBy("_file", "_order").collect()
    got = {}
    for r in rows:
        name = r["_file"].rsplit("/", 1)[1].removesuffix(".json")
        got.setdefault(name, []).append((r.city_id, r.city_name, r.country, r.timezone, r["_error"]))
    assert got["list"] == [("1", "N/A", None, None, None), ("2", None, None, None, None)]
    assert got["bare"] == [("1", "N/A", None, None, None)]
    assert got["empty"][0][4] == json_files.EMPTY_LIST
    assert got["broken"][0][4] == "Malformed JSON"
    assert got["scalar"][0][4] == "Malformed JSON"
    assert got["lacking"][0][4] == "Missing required columns: city_name, country, timezone"
    assert got["scalars"][0][4] == "Malformed JSON"


def test_md5_equals_hashlib(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a,b\n1,\xff\n")
    (f,) = facts(spark, tmp_path)
    assert f.md5 == hashlib.md5(b"a,b\n1,\xff\n").hexdigest() and not f.is_utf8 and f.header == "a,b"


def test_pending_needs_same_content_and_success(spark):
    seen = local_frame(spark, [("p1", "m1"), ("p2", "m2"), ("p3", "m3"), ("p4", "m4")], "_file string, md5 string")
    rows = [("p1", "m1", None, "success", 1, 0), ("p2", "old", None, "success", 1, 0), ("p3", "m3", None, "skipped", 0, 0)]
    ledger = local_frame(spark, rows, LEDGER_SCHEMA)
    left = lambda *terminal: sorted(r["_file"] for r in files.pending(seen, ledger, terminal).collect())
    assert left("success") == ["p2", "p3", "p4"]
    assert left("success", "skipped") == ["p2", "p4"]


def test_ledger_keeps_one_row_per_path(spark):
    rows = [("day-1/a", "m", None, "failed", 0, 0), ("day-2/b", "m", None, "success", 5, 1)]
    ledger = local_frame(spark, rows, LEDGER_SCHEMA)
    outcomes = local_frame(spark, [("day-1/a", None, "success", 7, None), ("day-1/c", "m3", "skipped", None, 2)],
                           "_file string, md5 string, status string, rows_loaded bigint, rows_rejected bigint")
    after = mark_done(ledger, ledger_rows(outcomes, "2026-01-01 00:00:00"))
    assert status_of(after, "day-1/a").collect()[0][1:] == ("unknown", after.where("file_path = 'day-1/a'").collect()[0][2], "success", 7, 0)
    assert [r.file_path for r in list_processed(after, "day-1").collect()] == ["day-1/a", "day-1/c"]
    assert list_processed(after).count() == 3


def test_json_texts_and_bad_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[{"city_id": 1, "city_name": "x", "country": null, "timezone": NaN}, {"city_id": 2, "city_name": "y"}]')
    (tmp_path / "b.json").write_text('[{"city_id": 1')
    (tmp_path / "c.json").write_text(" \n ")
    found = files.list_files(spark, str(tmp_path)).collect()
    assert [tuple(r)[2:] for r in json_files.read_json(spark, found, CITY).orderBy("_file", "_order").collect()] == [
        ("1", "x", None, None, None), ("2", "y", None, None, None), (None,) * 4 + ("Malformed JSON",)]


def test_large_text_files_are_hashed_by_line(spark, tmp_path, monkeypatch):
    """The hash doesn't depend on the splits, but on every byte and on the order of lines; the other facts are those of small files."""
    lines = [f"{i},name {i * 7 % 100}" for i in range(400)]
    texts = {"a": lines, "same": lines, "edit": [*lines[:-1], "399,name x"], "swap": [lines[1], lines[0], *lines[2:]], "short": lines[:-1], "quote": [*lines, '"x"']}
    for name, rows in texts.items():
        (tmp_path / f"{name}.csv").write_text("category_id,category_name\r\n" + "\n".join(rows))
    (tmp_path / "latin.csv").write_bytes(b"\n" + "id,é\n1,ü\n".encode("latin-1"))
    facts_of = lambda: {r["_file"].rsplit("/")[-1][:-4]: (r.md5, r.is_utf8, r.header, r.has_quotes) for r in facts(spark, tmp_path)}
    small = facts_of()
    monkeypatch.setattr(files, "LARGEST_FILE", 5)
    large = facts_of()
    assert {k: v[1:] for k, v in large.items()} == {k: v[1:] for k, v in small.items()}
    assert large["latin"][1:3] == (False, "id,é") and large["a"][0] == large["same"][0] and len({v[0] for v in large.values()}) == len(texts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        assert facts_of() == large
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_json_files_are_hashed_by_piece(spark, tmp_path, monkeypatch, small_splits):
    rows = [{"id": n, "name": f"x{n}}}"} for n in range(50)]
    texts = {"a": rows, "same": rows, "swap": [rows[1], rows[0], *rows[2:]], "short": rows[:-1]}
    for name, value in texts.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    monkeypatch.setattr(files, "LARGEST_FILE", 5)
    marked = lambda: {r["_file"].rsplit("/")[-1][:-5]: (r.md5, r.is_utf8, r.header, r.has_quotes) for r in files.fingerprint(
        spark, files.list_files(spark, str(tmp_path)), as_text=False).collect()}
    found = marked()
    assert found["a"] == found["same"] and len({f[0] for f in found.values()}) == 3 and found["a"][1:] == (True, None, False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    assert marked() == found


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def quoted_csv(seed, rows, width=2):
    """Fields with newlines, commas and doubled quotes, literal quotes inside unquoted ones, blank lines and lines of the wrong width."""
    rng = random.Random(seed)
    pieces = ["a", "bc", "\n", "\n\n", ",", '""', " ", "\né", "x y", ',""\n""']

    def field():
        kind = rng.random()
        if kind < 0.5:
            return "".join(rng.choice(["a", "bc", " d", "é"]) for _ in range(rng.randint(0, 4)))
        if kind < 0.6:
            return 'in"side' + rng.choice(["", '"', " z"])
        return '"' + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) + '"'

    lines = [",".join(field() for _ in range(rng.choice([width] * 6 + [1, width + 1, width + 2]))) for _ in range(rows)]
    return "category_id,category_name\n" + "\n".join(lines) + rng.choice(["", "\n", "\n\n"])


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_records_over_lines_equal_the_whole_file_reader(spark, tmp_path, small_splits, encoding):
    for seed in range(6):
        (tmp_path / f"{seed}.csv").write_bytes(("\n\n" if seed == 3 else "").encode() + quoted_csv(seed, 60).encode(encoding))
    found = facts(spark, tmp_path)
    how = csv_records.layouts(spark, found, "UTF-8" if encoding == "utf-8" else "ISO-8859-1")
    assert set(how.values()) == {csv_records.RECORDS} and len(how) == 6
    by_records = csv_files.read_csv(spark, found, CATEGORY)
    whole = csv_files._read_group(spark, [f.path for f in found], ["category_id", "category_name"], "UTF-8" if encoding == "utf-8" else "ISO-8859-1", csv_records.WHOLE, CATEGORY)

    def rows(df):
        out = {}
        for r in df.orderBy("_file", "_order").collect():
            out.setdefault(r["_file"], []).append((r.category_id, r.category_name))
        return out

    assert rows(by_records) == rows(whole) and sum(map(len, rows(whole).values())) > 200
    read = csv_records.read_records(spark, [found[0].path], "UTF-8")
    assert spark.read.text(found[0].path).rdd.getNumPartitions() > 5 and read.select("block").distinct().count() > 5


def test_layouts(spark, tmp_path, small_splits):
    """Quotes within lines are no reason to read a file whole; a field that is never closed or has an odd quote is."""
    texts = {"plain": '1,"a, b"\n2,"say ""hi"""\n3,5" pipe\n', "spans": '1,"a\nb"\n', "open": '1,"a\nb\n' * 3, "odd": '1,"a\nb" c"\n2,"d\ne"\n'}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text("category_id,category_name\n" + text)
    how = {k.rsplit("/", 1)[1]: v for k, v in csv_records.layouts(spark, facts(spark, tmp_path), "UTF-8").items()}
    assert how == {"plain.csv": csv_records.LINES, "spans.csv": csv_records.RECORDS, "open.csv": csv_records.WHOLE, "odd.csv": csv_records.WHOLE}
    assert csv_records.layouts(spark, [], "UTF-8") == {}


def json_text(rng, value):
    return json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]))


def test_members_of_split_arrays_equal_the_whole_file_reader(spark, tmp_path, small_splits, monkeypatch):
    """Braces, quotes and backslashes in strings, nested values, white space, repeated members, files cut short or with surplus: same rows, same errors."""
    rng = random.Random(4)
    texts = ["a", "}", "{", '"', "\\", "\\\"}", "é", "},{", "[", "\n", "x" * 90, "]"]

    def member():
        name = "".join(rng.choice(texts) for _ in range(rng.randint(0, 6)))
        country = rng.choice([name, None, {"deep": [{"}": name}, {}]}, 2.5, True, [1, {"a": "{"}]])
        return {"city_id": rng.randint(0, 99), "city_name": name, "country": country, "timezone": "t"}

    for n in range(8):
        rows = [member() for _ in range(30)]
        sep = rng.choice([",", ", ", ",\n  "])
        (tmp_path / f"list{n}.json").write_text("[" + sep.join(json_text(rng, r) for r in rows + rows[:2]) + rng.choice(["]", "]\n", "\n ] \n"]))
    one = member()
    (tmp_path / "bare.json").write_text(json.dumps(one) + "\n")
    (tmp_path / "cut.json").write_text(json.dumps([member() for _ in range(9)])[:-30])
    (tmp_path / "lacking.json").write_text(json.dumps([{"city_id": n, "city_name": "{"} for n in range(20)]))
    found = files.list_files(spark, str(tmp_path)).collect()

    def rows():
        out = {}
        for r in json_files.read_json(spark, found, CITY).orderBy("_file", "_order").collect():
            out.setdefault(r["_file"].rsplit("/", 1)[1], []).append((r.city_id, r.city_name, r.country, r.timezone, r["_error"]))
        return out

    whole = rows()
    monkeypatch.setattr(json_files, "SPLIT_FROM", 0)
    assert rows() == whole
    assert [len(whole[f"list{n}.json"]) for n in range(8)] == [32] * 8 and whole["cut.json"][0][4] == "Malformed JSON"
    path = next(f.path for f in found if f.path.endswith("list0.json"))
    assert json_records.members(spark, [path]).select("block").distinct().count() > 5
