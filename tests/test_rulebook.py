"""Rule files, rules in published insights, the ledger by day, responses as a data source."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.quality import RuleBook
from millrace.plans import insights
from millrace.plans.rules import JOIN_KEYS, RULES, join_rules
from millrace.sources.datasource import chains, names, read_responses, unnamed
from millrace.sources.ledger import Ledger
from millrace.sources.responses import ITEM_SCHEMAS, flatten
from millrace.sources.tables import VersionedTable


def test_rule_files(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    book = RuleBook.from_file(spark, str(tmp_path / "rules.json"))
    assert book.rules("channels")[0].unique and len(book.joins) == 2 and book.rules("none") == []
    assert [r["target_table"] for r in book.joins_of({"trending_videos", "channels"})] == ["channels"]
    yaml = pytest.importorskip("yaml")
    (tmp_path / "rules.yaml").write_text(yaml.safe_dump(RULES))
    assert RuleBook.from_file(spark, str(tmp_path / "rules.yaml")) == book
    (tmp_path / "list.json").write_text("[]")
    with pytest.raises(ValueError, match="no rules"):
        RuleBook.from_file(spark, str(tmp_path / "list.json"))


def test_join_rules_name_what_the_jobs_read():
    assert set(JOIN_KEYS) == set(insights.INSIGHTS)
    for job in JOIN_KEYS:
        for rule in join_rules(job):
            assert {rule["source_table"], rule["target_table"]} <= set(insights.DEPENDENCIES[job])


def test_rules_of_a_published_insight(spark, tmp_path):
    golden, out, report = (str(tmp_path / n) for n in ("golden", "out", "report"))
    videos = spark.createDataFrame(
        [("v1", "c1", 1, 1, 1, 1.0), ("v2", "c9", 2, 2, 2, 2.0)],
        "video_id string, channel_id string, views int, likes int, comments int, engagement_rate double",
    )
    channels = spark.createDataFrame([("c1", "One"), ("c2", "Two")], "channel_id string, channel_name string")
    VersionedTable(spark, f"{golden}/trending_videos/current").replace(videos)
    VersionedTable(spark, f"{golden}/channels/current").replace(channels)
    book = RuleBook.from_config({**RULES, "channel_growth_metrics": {"rules": [
        {"column": "channel_id", "type": "string", "null_allowed": False, "unique": True},
        {"column": "total_views", "type": "numeric", "min_value": 5}]}})
    name = "channel_growth_metrics"
    stored = insights.publish(spark, name, golden, out, book=book, report=report)
    assert stored.read().count() == 1
    found = spark.read.parquet(f"{report}/rules").select("column", "check", "violations", "passed")
    assert rows(found) == [("channel_id", "null", 0, True), ("channel_id", "unique", 0, True), ("total_views", "min_value", 1, False)]
    joins = spark.read.parquet(f"{report}/joins").select("source_table", "target_table", "orphans", "passed")
    assert rows(joins) == [("channels", "trending_videos", 1, False), ("trending_videos", "channels", 1, False)]
    before = stored.version(), sorted(p.name for p in Path(out, "data").iterdir())
    with pytest.raises(ValueError, match="total_views.min_value"):
        insights.publish(spark, name, golden, out, book=book, blocking=True)
    assert (stored.version(), sorted(p.name for p in Path(out, "data").iterdir())) == before
    fine = RuleBook.from_config({})
    assert insights.publish(spark, name, golden, str(tmp_path / "fine"), book=fine).read().count() == 1


def test_ledger_by_day(spark, tmp_path):
    book = Ledger(spark, str(tmp_path))
    book.note_all([])
    book.note_all([{"entity": "task_run", "id": str(i), "status": "SUCCESS", "details": {"n": i}} for i in range(3)])
    book.note("task_run", "x", "FAILED")
    with pytest.raises(ValueError, match="unknown ledger entity"):
        book.note_all([{"entity": "person", "id": "1", "status": "x"}])
    days = [p.name for p in tmp_path.iterdir() if p.name.startswith("day=")]
    assert len(days) == 1 and len(list(tmp_path.glob("day=*/*.json"))) == 2
    old = tmp_path / "day=2020-01-02"
    old.mkdir()
    (old / "a.json").write_text(json.dumps({"entity": "task_run", "id": "old", "status": "SUCCESS", "at": "2020-01-02T00:00:00Z"}))
    assert book.rows().count() == 5 and "day" not in book.rows().columns
    assert rows(book.rows(until="2020-12-31").select("id")) == [("old",)]
    recent = book.rows(since="2021-01-01")
    assert recent.count() == 4 and recent.inputFiles() and not any("2020" in f for f in recent.inputFiles()) or "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().executedPlan().toString()


ITEMS = {
    "videos": {"id": "v1", "snippet": {"title": "t", "tags": ["a", "b"], "categoryId": "1"}, "statistics": {"viewCount": "5"}},
    "channels": {"id": "c1", "snippet": {"title": "t", "country": "VN"}, "statistics": {"viewCount": "5"}},
    "search": {"id": {"videoId": "v"}, "snippet": {"title": "t", "thumbnails": {"high": {"url": "u"}}}},
    "categories": {"id": "1", "snippet": {"title": "Film"}},
    "threads": {"id": "t1", "snippet": {"totalReplyCount": 1, "topLevelComment": {"snippet": {"videoId": "v", "textDisplay": "x\ny"}}}},
    "comments": {"id": "r1", "snippet": {"authorDisplayName": "é", "authorChannelId": {"value": "c"}}},
}


@pytest.mark.parametrize("kind", sorted(ITEM_SCHEMAS))
def test_all_kinds_as_a_data_source(spark, tmp_path, kind):
    plain, drifted = ITEMS[kind], {**ITEMS[kind], "etag": "e", "snippet": {**ITEMS[kind]["snippet"], "mood": [1, {"a": None}]}}
    pages = [[plain, drifted], [plain, {**plain, "kind": "other"}]]
    for n, items in enumerate(pages):
        line = json.dumps({"body": json.dumps({"items": items}), "key": "k"})
        (tmp_path / f"a-page-{n}.json").write_text(f"{line}\n\nno json\n" + json.dumps({"body": "[]"}) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({"body": json.dumps({"items": [plain]})}))
    (tmp_path / "_ignored.json").write_text("x")
    got = read_responses(spark, str(tmp_path), kind, ["key"])
    bodies = [(json.dumps({"items": [i]}), k) for i, k in ((plain, "k"), (drifted, "k"), ({**plain, "kind": "other"}, "k"), (plain, None))]
    want = flatten(spark.createDataFrame(bodies, "body string, key string"), kind, stamp=["key"])
    assert dict(got.dtypes)["extra"] == "variant" and got.rdd.getNumPartitions() == 2
    assert rows(got.drop("extra")) == rows(want)
    extra = {json.dumps(json.loads(r.x), sort_keys=True) if r.x else None for r in got.select(F.to_json("extra").alias("x")).collect()}
    assert extra == {None, '{"etag": "e", "snippet": {"mood": [1, {"a": null}]}}', '{"kind": "other"}'}
    one = read_responses(spark, f"{tmp_path}/b*.json", kind)
    assert one.count() == 1


def test_chains_of_pages():
    assert chains(["d/b-page-10.json", "d/b-page-2.json", "d/a.json", "d/b-page-2x.json"]) == [
        ("d/a.json",), ("d/b-page-2x.json",), ("d/b-page-2.json", "d/b-page-10.json")]
    known = names("a int, b struct<c:string, d:struct<e:array<string>>>")
    assert known == {"a": None, "b": {"c": None, "d": {"e": None}}}
    assert unnamed({"a": 1, "b": {"c": 1}}, known) is None and unnamed("x", None) is None
    assert unnamed({"a": {"x": 1}, "b": {"d": {"e": 1, "f": 2}}}, known) == {"b": {"d": {"f": 2}}}
