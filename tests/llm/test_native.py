"""Native operators on rows with nulls, ties, repeats and clashing columns."""

import hashlib
import re

import messy
from soukline.llm import chat, exact_dedup, mixing, url_rules


def test_exact_dedup_matches_brute_force(spark):
    rows = messy.rows() + messy.repeated()
    got = exact_dedup.exact_dedup(messy.documents(spark, messy.repeated())).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    want = {}
    for body, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        want[hashlib.sha256(body.encode()).hexdigest()] = (best[0], len(members))
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)             # exactly one survivor of every group
    assert {(r.doc_id, r.text_sha256) for r in kept} == {(v[0], k) for k, v in want.items()}


def test_keep_exact_returns_whole_rows(spark):
    docs = messy.documents(spark, messy.repeated())
    kept = exact_dedup.keep_exact(docs)
    assert kept.columns == docs.columns
    bodies = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(bodies) == len(set(bodies))


def test_winner_does_not_depend_on_partitions(spark):
    docs = messy.documents(spark)
    one = exact_dedup.exact_dedup(docs.coalesce(1)).orderBy("doc_id").collect()
    many = exact_dedup.exact_dedup(docs.repartition(13), salts=3).orderBy("doc_id").collect()
    assert one == many


def test_mix_meets_targets(spark):
    docs = messy.documents(spark, messy.repeated())
    got = mixing.taken_words(docs, block_words=16).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        t = by.setdefault((r.source_size, r.target), [0, 0])
        t[0] += r.taken
        t[1] += r["size"]
    for (size, target), (taken, words) in by.items():
        assert words == size and taken == int(target)
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-6


def test_targets_cap_and_reshare(spark):
    parts = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1), (None, 79)],
                                  "source string, words long")
    got = {r.source: (r.weight, r.target) for r in mixing.source_targets(parts).collect()}
    # c: weight 3, capped at 3 words; a and null weigh 1, b weighs 2 and is capped at 30
    assert got["c"] == (3, 3.0)
    assert got["b"] == (2, 30.0)
    assert got["a"] == (1, 30.0)
    assert got[None] == (1, 37.0)


def test_schedule_is_even_in_every_stretch(spark):
    targets = spark.createDataFrame([(1, 64 * 300), (2, 64 * 600), (3, 64 * 100)],
                                    "ord int, quota long")
    slots = mixing.schedule(targets, 64).orderBy("slot").collect()
    assert len({s.slot for s in slots}) == len(slots) == 1000
    for o, n in ((1, 300), (2, 600), (3, 100)):
        mine = [s.block for s in slots if s.ord == o]
        assert mine == list(range(n))           # ranks follow the schedule
        for lo in range(0, 1000, 125):
            share = sum(s.ord == o for s in slots[lo:lo + 125]) / 125
            assert abs(share - n / 1000) < 0.06


def test_mixed_documents_repeat_whole_rows(spark):
    docs = messy.documents(spark)
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times and max(times.values()) <= 3


def test_chat_collapse_and_render(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "bye"),
             (2, 0, "user", "hi"), (2, 1, "assistant", "yo"),            # snapshot of 1
             (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "bye"),  # copy
             (4, 0, "user", "hi"), (4, 1, "assistant", "no"),
             (5, 0, "user", None), (6, 0, "user", ""), (7, None, None, "x"),
             (8, 0, "user", "a"), (8, 0, "user", "a"), (9, 0, "user", "a"),
             (None, 0, "user", "nobody"), (None, 1, "user", "else")]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns],
                               "conv_id long, turn long, role string, text string,"
                               " pos string, n_turns int")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert {i for i, r in got.items() if r.kept} == {1, 4, 5, 6, 7, 8, None}
    assert got[3].keep_id == 1 and got[3].maximal and not got[3].kept
    assert not got[2].maximal and not got[9].maximal
    assert got[4].chat == "<|user|>\nhi<|end|>\n<|assistant|>\nno<|end|>\n"
    assert got[7].chat == "<|none|>\nx<|end|>\n"
    assert chat.format_chats(df.filter("false")).count() == 0


def test_url_rules(spark):
    pages = [(1, "http://www.example.com/en/x"), (2, "https://EXAMPLE.com/en/"),
             (3, "http://a.net/es/q?x#y"), (4, "http://a.net"), (5, None), (6, "no scheme"),
             (7, "http://notexample.com/en/"), (8, "http://a.org/"), (8, "http://a.org/"),
             (None, "http://b.net/fr/1"), (9, "http://b.net/fr"), (10, "x://y://com/"),
             (11, "http:///en/"), (12, "http://com/é")]
    df = spark.createDataFrame([(*p, "z", "h") for p in pages],
                               "page_id long, url string, host string, verdict string")
    got = url_rules.judge_urls(df, url_rules.rule_frame(spark)).collect()
    assert len(got) == len(pages)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert by[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert by[3] == ("a.net", "/es/q", "net/es/", "block")
    assert by[4] == ("a.net", "", None, "allow")
    assert by[5] == by[6] == ("", "", None, "allow")
    assert by[7][2] == "com/" and by[8][2] is None
    assert by[None][2] == "net/fr/" and by[9][2] is None
    assert by[10][:2] == ("y:", "//com/") and by[11] == ("", "/en/", None, "allow")
    assert by[12] == ("com", "/é", "com/", "allow")


def test_no_rules_and_no_pages(spark):
    none = url_rules.rule_frame(spark).filter("false")
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_rules.judge_urls(df, none).first().verdict == "allow"
    assert url_rules.judge_urls(df.filter("false"), none).count() == 0
    rules = [("block", "a.com", "/x"), ("block", None, "/"), ("allow", "a.com", "/xy")]
    df = spark.createDataFrame([(1, "http://a.com/xyz"), (2, "http://a.com/xa")],
                               "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judge_urls(
        df, url_rules.rule_frame(spark, rules)).collect()}
    assert got == {1: "allow", 2: "block"}


def test_empty_tables(spark):
    docs = messy.empty(spark)
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert exact_dedup.keep_exact(docs).count() == 0
    assert mixing.taken_words(docs).count() == 0
    assert mixing.mixed_documents(docs).count() == 0
