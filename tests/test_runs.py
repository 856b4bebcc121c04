"""Notifications that start runs."""

import json

from conftest import rows

from millrace.plans.raw import build_raw
from millrace.sources import manifest as m
from millrace.sources.ledger import Ledger, latest_status
from millrace.sources.tables import AppendTable, stored_table
from millrace.streaming.notifications import CREATED, read_events
from millrace.streaming.runs import Runs


def announce(folder, name, *keys):
    lines = [
        json.dumps({"EventName": CREATED, "Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k.replace("/", "%2F")}}}]})
        for k in keys
    ]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def thread(ident, likes):
    return {"id": ident, "snippet": {"totalReplyCount": 1, "topLevelComment": {"snippet": {
        "videoId": "v1", "authorDisplayName": f"author of {ident}", "textDisplay": "nice",
        "likeCount": likes, "publishedAt": "2024-02-03T00:00:00Z"}}}}


def raw(spark, root, day, threads):
    dumps = root / f"dumps-{day}"
    dumps.mkdir(parents=True)
    (dumps / "1.json").write_text(json.dumps({"body": json.dumps({"items": [thread(*t) for t in threads]})}))
    batch = m.Batch(str(root), "site", "raw", "comment_threads", day, 1)
    build_raw(spark, str(dumps), batch)
    return batch.manifest_path.removeprefix(str(root)).lstrip("/")


def test_notifications_build_golden_tables_once(spark, tmp_path):
    root, inbox = tmp_path / "lake", tmp_path / "inbox"
    book = Ledger(spark, str(tmp_path / "ledger"))
    sent = []

    def runs():
        return Runs(spark, str(root), str(root / "golden"), str(tmp_path / "marks"), ledger=book, announce=sent.append)

    def follow(checkpoint="checkpoint"):
        runs().follow(read_events(spark, str(inbox)), str(tmp_path / checkpoint))
        threads = stored_table(spark, str(root / "golden/comment_threads/current")).read()
        history = AppendTable(spark, str(root / "golden/comment_threads/history")).read()
        return rows(threads.select("comment_thread_id", "comment_likes")), history.count()

    first = raw(spark, root, "20240601", [("t1", 1), ("t2", 2)])
    announce(inbox, "1.json", first, "site/raw/comment_threads/data.csv", "site/raw/unknown/control_file.json")
    assert follow() == ([("t1", 1), ("t2", 2)], 2)
    second = raw(spark, root, "20240602", [("t2", 5), ("t3", 3)])
    announce(inbox, "2.json", second, first, "site/raw/comment_threads/absent/control_file.json")
    want = [("t1", 1), ("t2", 5), ("t3", 3)], 4
    assert follow() == want
    # a restart from the checkpoint, and one that has lost it, add nothing
    done = len(sent)
    assert follow() == want and follow("another checkpoint") == want
    assert len(sent) == done == 4
    assert rows(stored_table(spark, str(root / "golden/authors")).read().select("author_name")) == [
        ("author of t1",), ("author of t2",), ("author of t3",)
    ]
    runs_ = latest_status(book.rows().filter("entity = 'execution'"), ["id"])
    assert rows(runs_.groupBy("status").count()) == [("FAILED", 1), ("SUCCESS", 2)]


def test_a_run_that_died_is_run_again_without_a_trace(spark, tmp_path, monkeypatch):
    from millrace.plans import runner

    root = tmp_path / "lake"
    key = raw(spark, root, "20240601", [("t1", 1)])
    runs = Runs(spark, str(root), str(root / "golden"), str(tmp_path / "marks"))
    save, calls = runner.save, []

    def dies(df, output, *more, **named):
        calls.append(output["dataframe"])
        if len(calls) == 2:
            raise OSError("lost")
        return save(df, output, *more, **named)

    monkeypatch.setattr(runner, "save", dies)
    assert not runs.start("run", key, "comment_threads")
    history = AppendTable(spark, str(root / "golden/comment_threads/history"))
    assert history.read().count() == 1
    assert runs.start("run", key, "comment_threads") and runs.start("run", key, "comment_threads")
    assert history.read().count() == 1 and len(calls) == 4
