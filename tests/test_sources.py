from __future__ import annotations

import hashlib

import pytest

from reviewmill.operators.contract import ContractError
from reviewmill.schema import REVIEW_COLUMNS, TEXT
from reviewmill.sources import files, layers, reviews_csv, workspace

HEADER = ",".join(REVIEW_COLUMNS) + "\n"


def test_latin1_quotes_newlines_and_null_tokens(spark, tmp_path):
    body = '1,5,2019-4,Québec,"She said ""hi"",\nthen left",park_a\n2,NA,missing,N/A,null,park_b\n3,4,2018-1,,  padded ,None\n'
    (tmp_path / "r.csv").write_bytes((HEADER + body).encode("latin-1"))
    rows = reviews_csv.scan_reviews(spark, str(tmp_path / "r.csv")).orderBy("row_id").collect()
    assert rows[0][TEXT] == 'She said "hi",\nthen left' and rows[0]["Reviewer_Location"] == "Québec"
    assert rows[1]["Rating"] is None and rows[1]["Reviewer_Location"] is None and rows[1][TEXT] is None
    assert rows[1]["Year_Month"] == "missing"
    assert rows[2]["Reviewer_Location"] is None and rows[2][TEXT] == "  padded " and rows[2]["Branch"] is None


def test_round_trip_and_overwrite_guard(spark, make_reviews, tmp_path):
    rows = make_reviews([{TEXT: 'a "quoted" line\nand, more'}, {TEXT: " spaced "}, {TEXT: "é"}])
    path = str(tmp_path / "out")
    reviews_csv.write_reviews_csv(rows, path)
    back = reviews_csv.scan_reviews(spark, path).select(*REVIEW_COLUMNS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select(*REVIEW_COLUMNS).collect()))
    with pytest.raises(Exception, match="already exists"):
        reviews_csv.write_reviews_csv(rows, path)
    reviews_csv.write_reviews_csv(rows, path, overwrite=True)


def test_contract_on_scan(spark, tmp_path):
    (tmp_path / "r.csv").write_text(HEADER + "1,9,2019-4,x,y,z\n")
    with pytest.raises(ContractError):
        reviews_csv.scan_reviews(spark, str(tmp_path / "r.csv"))
    assert reviews_csv.scan_reviews(spark, str(tmp_path / "r.csv"), validate=False).count() == 1
    (tmp_path / "s.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ContractError):
        reviews_csv.scan_reviews(spark, str(tmp_path / "s.csv"))


def test_largest_csv_is_found_below_the_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "small.csv").write_text("x")
    (tmp_path / "deep" / "big.csv").write_text("x" * 100)
    (tmp_path / "huge.txt").write_text("x" * 1000)
    assert reviews_csv.largest_csv(spark, str(tmp_path)).first()["path"].endswith("deep/big.csv")
    assert reviews_csv.largest_csv(spark, str(tmp_path), recursive=False).first()["path"].endswith("small.csv")
    assert reviews_csv.largest_csv(spark, str(tmp_path / "deep"), recursive=True).count() == 1


@pytest.mark.parametrize("inline_limit", [10**9, 0, 5])
def test_digests_whole_or_streamed(spark, tmp_path, inline_limit):
    contents = {"a.bin": b"abc", "b.bin": bytes(range(256)) * 9000}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    expected = hashlib.sha256(b"abc").hexdigest()
    found = files.file_inventory(spark, str(tmp_path), expected_sha256=expected, inline_limit=inline_limit).collect()
    assert len(found) == 2
    for row in found:
        data = contents[row["path"].rsplit("/", 1)[1]]
        assert (row["length"], row["md5"], row["sha256"]) == (len(data), hashlib.md5(data).hexdigest(), hashlib.sha256(data).hexdigest())
        assert row["verified"] == (data == b"abc")
    totals = files.inventory_totals(files.file_inventory(spark, str(tmp_path))).first()
    assert (totals["files"], totals["bytes"]) == (2, sum(map(len, contents.values())))


def test_workspace_uses_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "x").startswith(folder)
    table = workspace.materialise(spark.range(5), "five")
    assert table.count() == 5 and table.inputFiles()[0].startswith("file://" + folder)
    workspace.sweep(spark)
    with pytest.raises(Exception):
        table.count()


def test_unfinished_layers_are_refused(spark, make_reviews, tmp_path):
    rows = make_reviews([{"Rating": r, "Review_Text": f"text {i}"} for i, r in enumerate([1, 3, 5] * 8)])
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    layers.build_splits(spark, silver, gold, raw=lambda: rows)
    placed = layers.with_saved_splits(spark.read.parquet(silver), gold)
    joined = layers.all_split_rows(spark.read.parquet(silver), layers.load_splits(spark, gold))
    key = lambda df: sorted((r["row_id"], r["split"]) for r in df.collect())
    assert key(placed) == key(joined)
    (tmp_path / "gold" / "_SUCCESS").unlink()
    for read in (layers.load_splits, lambda s, p: layers.build_splits(s, silver, p)):
        with pytest.raises(layers.IncompleteTable):
            read(spark, gold)
    with pytest.raises(FileNotFoundError):
        layers.load_splits(spark, str(tmp_path / "nothing"))
