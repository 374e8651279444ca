"""Readers, writers and cleaning chains on small inputs."""

import random

import pytest
from pyspark.sql import types as T

from streetloom import schemas
from streetloom.dimensions import inline_table
from streetloom.operators.sentiment import lexicon_sentiment
from streetloom.plans.businesses import clean_businesses, location_counts
from streetloom.plans.requests import clean_requests, request_counts
from streetloom.plans.reviews import clean_reviews, retention, reviews_of
from streetloom.session import scratch_path
from streetloom.sources import (
    read_csv,
    read_csv_positional,
    read_jsonl,
    read_parquet,
    rejected_files,
    rejected_records,
    write_by_radius,
    write_csv,
)
from test_expressions import TAXONOMY


def test_csv_keeps_line_breaks_quotes_blanks_and_zip_text(spark):
    path = scratch_path(spark, "csv")
    data = [("r1", "b", 4.0, 'two\nlines, "quoted" ', "2024-01-01", 3), ("r2", "01", None, "  x", None, None)]
    write_csv(spark.createDataFrame(data, schemas.REVIEW_RAW), path)
    got = sorted(map(tuple, read_csv(spark, path, schemas.REVIEW_RAW).collect()))
    assert got == data


def test_jsonl_projection_and_limit(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"business_id": "1", "name": "x", "hours": {"Mon": "9-5"}, "other": 1}\n{"business_id": "2"}\n')
    df = read_jsonl(spark, str(path), schemas.BUSINESS_RAW, columns=["business_id", "hours"])
    assert sorted(map(tuple, df.collect())) == [("1", {"Mon": "9-5"}), ("2", None)]
    assert read_jsonl(spark, str(path), schemas.BUSINESS_RAW, nrows=1).count() == 1


def test_positional_directory_skips_header_and_other_widths(spark, tmp_path):
    width = len(schemas.REQUESTS_RAW)
    good = ",".join(["1", "2", '"a\nb"'] + ["x"] * (width - 5) + ["40.5", "bad"])
    (tmp_path / "good.csv").write_text(",".join(f"h{i}" for i in range(width)) + "\n" + good + "\n")
    (tmp_path / "narrow.csv").write_text("a,b\n1,2\n")
    (tmp_path / "notes.txt").write_text("a\n1\n")
    got = read_csv_positional(spark, str(tmp_path)).collect()
    assert len(got) == 1
    assert (got[0].objectid, got[0].subject, got[0].lat, got[0].lon) == (1, "a\nb", 40.5, None)
    assert [r.file.rsplit("/", 1)[-1] for r in rejected_files(spark, str(tmp_path)).collect()] == ["narrow.csv"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_odd_records_do_not_take_their_neighbours_along(spark, tmp_path, multi_line):
    width = len(schemas.REQUESTS_RAW)
    record = lambda key, n: ",".join([str(key), *['"x, ""y"""'] * (n - 1)])
    header = ",".join(f"h{i}" for i in range(width))
    lines = [header, record(1, width), record(2, width + 1), record(3, width), record(4, 3), record(5, width + 4)]
    (tmp_path / "mixed.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "good.csv").write_text(f"{header}\n{record(6, width)}\n")
    got = {r.objectid: r for r in read_csv_positional(spark, str(tmp_path), multi_line=multi_line).collect()}
    assert sorted(got) == [1, 3, 4, 6]
    assert got[4].subject == 'x, "y"' and got[4].status is None and got[3].zipcode == 'x, "y"'
    assert rejected_files(spark, str(tmp_path)).count() == 0
    rejected = rejected_records(spark, str(tmp_path), multi_line=multi_line).collect()
    assert sorted(r.record.split(",")[0] for r in rejected) == ["2", "5"]
    assert {r.file.rsplit("/", 1)[-1] for r in rejected} == {"mixed.csv"}


@pytest.fixture
def small_splits(spark):
    """Every file is cut into splits of 70 bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "70b")
    yield
    spark.conf.set(name, before)


def _csv_folder(folder, seed, closed=True):
    rng = random.Random(seed)
    words = ["", "a", "b c", 'say ""x""', "one\ntwo", "\n\n", "x" * 90, "é", ",,", "end\n", '""']
    rows = []
    for number in range(4):
        lines = ["key,first,second"]
        for _ in range(rng.choice([0, 1, 40, 120])):
            key = f"{number}-{len(lines)}"
            fields = [rng.choice(words) for _ in range(2)]
            lines.append(",".join([key, *(f'"{f}"' for f in fields)]))
            rows.append((key, *(f.replace('""', '"') or None for f in fields)))
        lines += ["", "  "]
        (folder / f"part{number}.csv").write_text("\n".join(lines) + "\n")
    return sorted(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_line_breaks_across_splits(spark, tmp_path, small_splits, seed):
    want = _csv_folder(tmp_path, seed)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("key", "first", "second")])
    got = read_csv(spark, str(tmp_path), schema)
    empty = lambda row: tuple(v or None for v in row)
    assert sorted(map(empty, got.collect())) == want
    if want:
        assert got.rdd.getNumPartitions() > 4
        assert "multiLine" not in got._jdf.queryExecution().toString()
    whole = spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    assert want == sorted(map(empty, whole.where("trim(key) <> ''").collect()))


def test_one_record_over_many_splits_and_an_unclosed_quote(spark, tmp_path, small_splits):
    body = "\n".join(f"line {k}" for k in range(200))
    (tmp_path / "a.csv").write_text(f'k,v\n1,"{body}"\n2,x\n')
    (tmp_path / "b.csv").write_text('k,v\n3,y\n4,"never\nclosed')
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    got = {r.k: r.v for r in read_csv(spark, str(tmp_path), schema).collect()}
    assert got == {1: body, 2: "x", 3: "y", 4: "never\nclosed"}


def test_splits_stay_where_only_some_files_have_crossing_records(spark, tmp_path):
    """The size of splits comes from that of all files together."""
    body = "\n".join(f"line {k}" for k in range(15_000))
    (tmp_path / "a.csv").write_text(f'k,v\n1,"{body}"\n')
    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"{k},plain\n" for k in range(2, 20_002)))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1b")
    try:
        got = {r.k: r.v for r in read_csv(spark, str(tmp_path), schema).collect()}
    finally:
        spark.conf.set(name, before)
    assert got == {1: body, **{k: "plain" for k in range(2, 20_002)}}


def test_a_header_with_other_names_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,other\n1,2\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), schema).collect()
    assert read_csv(spark, str(tmp_path), schema, header=False).count() == 2


def test_positional_rows_come_from_one_scan(spark, tmp_path):
    width = len(schemas.REQUESTS_RAW)
    (tmp_path / "a.csv").write_text(",".join(["h"] * width) + "\n" + ",".join(["1"] * width) + "\n")
    plan = read_csv_positional(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_radius_runs_do_not_replace_each_other(spark):
    path = scratch_path(spark, "radius")
    write_by_radius(spark.range(3), path, 100)
    write_by_radius(spark.range(5), path, 250)
    write_by_radius(spark.range(2), path, 100)
    counts = {r.radius_m: r["count"] for r in read_parquet(spark, path).groupBy("radius_m").count().collect()}
    assert counts == {100: 2, 250: 5}


def raw_requests(spark):
    def row(objectid, rid, **other):
        base = {
            "subject": " Subj ", "status_notes": None, "service_name": "Illegal  DUMPING",
            "requested_datetime": "2024-05-01 08:00:00", "zipcode": "19104.0", "lat": 40.0, "lon": -75.1,
        } | other
        return {"objectid": objectid, "service_request_id": rid} | base

    data = [
        row(1, 10),
        row(2, 10, subject="later copy"),
        row(3, 11, requested_datetime="2024-05-01 22:00:00"),
        row(4, 12, service_name="illegal dumping"),
        row(5, 13, lat=None),
        row(6, 14, subject=None),
        row(7, 15, subject=None, status_notes="n", lat=40.2, zipcode="1910"),
        row(8, 16, service_name=None),
    ]
    return spark.createDataFrame([tuple(r.get(n) for n in schemas.REQUESTS_RAW.names) for r in data], schemas.REQUESTS_RAW)


def test_clean_requests(spark):
    raw = raw_requests(spark)
    cleaned = clean_requests(raw).orderBy("objectid").collect()
    assert [r.objectid for r in cleaned] == [1, 4, 7]
    assert (cleaned[0].service_name, cleaned[0].subject, cleaned[0].zipcode) == ("illegal dumping", "subj", "19104")
    assert cleaned[2].zipcode is None and len(cleaned[0]) == 12
    # spelling variants count as one event only if labels come first
    assert [r.objectid for r in clean_requests(raw, labels_first=True).orderBy("objectid").collect()] == [1, 7]
    assert tuple(request_counts(raw).first()) == (8, 5, 4, 3, 1)


def test_clean_reviews_and_semi_join(spark):
    data = [
        ("r1", "b1", 5.0, "Good!", "2024-01-01", 0),
        ("r1", "b1", 5.0, "Other", "2024-01-01", 0),
        ("r2", "b1", 4.0, "Good!", "2024-01-02", 0),
        ("r3", "b2", 4.0, "Good!", "2024-01-02", 0),
        ("r4", "b2", 4.0, "...", "2024-01-02", 0),
        ("r5", "b2", 4.0, None, "2024-01-02", 0),
        ("r6", None, 4.0, "x", "2024-01-02", 0),
    ]
    raw = spark.createDataFrame(data, schemas.REVIEW_RAW)
    cleaned = clean_reviews(raw, ["review_id", "text"]).orderBy("review_id").collect()
    assert [(r.review_id, r.text_clean) for r in cleaned] == [("r1", "good"), ("r3", "good")]
    known = spark.createDataFrame([("b2",), ("b9",)], "business_id string")
    assert reviews_of(raw, known).count() == 3
    assert tuple(retention(raw, known).first()) == (7, 3, 42.9)


def test_clean_businesses(spark):
    def row(i, name, address, lat=40.0, n=1, cats=None, code="19104-1"):
        return (str(i), name, address, "c", "s", code, lat, -75.0, 4.0, n, 1, cats, None, None)

    raw = spark.createDataFrame(
        [
            row(1, "Joe's ", "12 Main St", n=5, cats="Bars"),
            row(2, "joe's", "12 Main Street", n=9, cats="Restaurants, Zoo"),
            row(3, "joe's", "999 Far Avenue", cats=None),
            row(4, "Ann", None, n=1),
            row(5, "Ann", None, n=3, code="12"),
            row(6, "Out", "x", lat=50.0),
            row(7, "Nowhere", "x", lat=None),
        ],
        schemas.BUSINESS_RAW,
    )
    got = clean_businesses(raw, TAXONOMY).orderBy("business_id").collect()
    assert [r.business_id for r in got] == ["2", "3", "5"]
    assert got[0].categories_normalized == ["Food & Restaurants", "zoo"]
    assert got[0].primary_category == "Food & Restaurants" and got[1].primary_category == "Uncategorized"
    assert got[0].postal_code == "19104" and got[2].postal_code is None
    assert tuple(location_counts(raw).first()) == (7, 1, 0, 1, 5, 1)


class _Session:
    """Stands for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = settings

    def get(self, name, default=None):
        return self._settings.get(name, default)


def test_scratch_goes_to_the_shared_folder():
    shared = _Session(**{"spark.checkpoint.dir": "s3://bucket/tmp/", "spark.master": "yarn"})
    assert scratch_path(shared, "x").startswith("s3://bucket/tmp/x-")
    assert scratch_path(_Session(**{"spark.master": "local[2]"}), "x") != scratch_path(shared, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Session(**{"spark.master": "yarn"}), "x")


def test_sentiment_cleans_raw_text_when_there_is_no_cleaned_one(spark):
    lexicon = inline_table(spark, [("good", 2.0, "word")], schemas.LEXICON)
    df = spark.createDataFrame([("r", "b", "GOOD!")], "review_id string, business_id string, text string")
    assert lexicon_sentiment(df, lexicon).first().review_sentiment == 0.4588


def test_sorted_csv_output(spark):
    path = scratch_path(spark, "sorted")
    write_csv(spark.createDataFrame([(3, ["x"]), (1, ["y", "z"]), (2, None)], "a int, b array<string>"), path, order_by=["a"])
    lines = [row.value for row in spark.read.text(path).orderBy("value").collect() if row.value != "a,b"]
    assert lines == ['1,"[""y"",""z""]"', "2,", '3,"[""x""]"']
