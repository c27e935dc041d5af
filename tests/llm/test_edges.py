"""Nulls, empty and odd texts, ties, repeated rows, empty tables and clashing column names."""

import gzip
import io
import itertools
import json
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from proxysift.llm import (
    components,
    decontamination,
    fingerprints,
    lm_scoring,
    mixing,
    ngram_join,
    span_dedup,
    tool_calls,
    toxicity,
    url_filter,
    warc,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "one two three four five six. seven eight nine ten eleven. twelve thirteen fourteen fifteen sixteen. "
ROWS = [
    (1, LONG, "en", "a", len(LONG)), (1, LONG, "en", "a", len(LONG)), (2, None, None, None, None), (3, "", "en", "a", 0),
    (None, "a null id", "en", "b", 9), (4, " \n\t ", "en", "b", 4), (5, LONG + "tail words here", "de", None, 3),
    (6, "word", "en", "b", 4), (7, "Ünïcode wörds 日本 \U0001f600", "xx", "b", 5), (8, "x " * 30_000, "en", "b", 60_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def crowded(docs):
    """The documents with columns named like those that operators make."""
    names = ["mark", "row", "key", "node", "size", "copy", "spans", "bucket", "words", "n_removed", "word", "_mark", "_id"]
    return docs.withColumns({name: F.lit("own") for name in names})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_fingerprints(docs, crowded, nothing):
    rows = fingerprints.fingerprints(crowded, 40).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {(r.doc_id, r.n_chars): r for r in rows}
    assert by[2, 0].fingerprint == by[3, 0].fingerprint == by[4, 4].fingerprint == ""
    assert by[2, 0].near_edited == 1.0 and by[2, 0].near_next == 0.0
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert fingerprints.fingerprints(nothing).collect() == []


def test_single_document_is_its_own_neighbour(spark):
    row = fingerprints.fingerprints(spark.createDataFrame([(7, "abc def ghi")], "doc_id bigint, text string")).first()
    assert row.near_next == 1.0


def test_span_dedup(docs, crowded, nothing):
    rows = span_dedup.without_repeated_spans(crowded).collect()
    assert len(rows) == len(ROWS) and {r.mark for r in rows} == {"own"}
    texts = {r.doc_id: r.text for r in rows}
    assert texts[1] == LONG and texts[2] is None and texts[3] == "" and texts[4] == " \n\t " and texts[None] == "a null id"
    assert texts[5] == "tail words here"
    assert span_dedup.without_repeated_spans(nothing).collect() == []


def test_sentences_cover_the_text():
    for text in ("", "a", "a.b", "A b. C d!  E\n\n\nf.", "\n\n", ". . .", "x?\n"):
        assert "".join(text[a:b] for a, b in span_dedup.sentence_bounds(text)) == text


def test_toxicity(spark, crowded, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, 0), (7, None), (8, 0)], "doc_id bigint, toxic int")
    tagger = toxicity.train(crowded, labels)
    rows = toxicity.toxicity_scores(crowded, tagger).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    untrained = toxicity.train(nothing, labels.limit(0))
    assert toxicity.toxicity_scores(nothing, untrained).collect() == []


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    steps = np.array([-1.0, -0.5, 0.7])
    for size in (1, 2, 5):
        emissions = rng.normal(size=size)
        found = toxicity.marginals([emissions, np.zeros(0)], steps)
        weights = np.zeros(size)
        total = 0.0
        for path in itertools.product((0, 1), repeat=size):
            score = float(np.dot(emissions, path)) + sum(
                {(0, 0): 0.0, (0, 1): steps[0], (1, 0): steps[1], (1, 1): steps[2]}[pair] for pair in itertools.pairwise(path)
            )
            total += math.exp(score)
            weights += math.exp(score) * np.array(path)
        assert found[0] == pytest.approx(weights / total) and len(found[1]) == 0


def test_toxic_offsets_are_places_of_the_text():
    tagger = toxicity.Tagger(weights={"=idiot": 20.0})
    for text in ("\u0130 an idiot", "an idiot \u0130\u0130 idiot", "\u03a3\u0130 IDIOT"):
        (spans,) = toxicity.score_rows(tagger, ["1"], [text])["offsets"]
        assert spans and all(text[s["start"] : s["stop"]].lower() == "idiot" for s in spans)


def test_shuffled_fingerprints(spark, docs, monkeypatch):
    """Without a broadcast the same rows, and no key without a value."""
    items = spark.createDataFrame([(10, LONG), (5, "word")], "item_id bigint, text string")
    expected = sorted(map(str, decontamination.contamination(docs, items).collect()))
    monkeypatch.setattr(decontamination, "fits_broadcast", lambda index: False)
    with_shuffle = decontamination.contamination(docs, items)
    assert sorted(map(str, with_shuffle.collect())) == expected


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame(
        [(10, LONG), (2, "Five, SIX -- seven!"), (3, None), (4, "?!"), (5, "word"), (6, "nowhere to be found")], "item_id bigint, text string"
    )
    rows = decontamination.contamination(docs, items).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_words, by[1].n_hit, by[1].n_items) == (16, 16, 2)
    assert (by[5].n_words, by[5].n_hit, by[5].n_items) == (19, 16, 2)
    assert (by[6].n_hit, by[6].n_items, by[2].n_words, by[2].contaminated) == (1, 1, 0, False)
    assert sum(r.doc_id == 1 for r in rows) == 2
    assert decontamination.contamination(nothing, items).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(docs, items.limit(0)).collect())


def test_urls(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("a.net", "/x/", "allow"), ("a.net", "/x/", "block"), ("b.net", None, "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    urls = [
        (1, "http://a.net/x/y?q#f"), (2, "HTTP://W.B.NET/"), (3, "http://net/"), (4, None), (5, "no scheme"), (6, "http://xnet/"),
        (7, "http://a.net:80/x/"), (None, "http://c.net/"), (1, "http://a.net/x/y?q#f"), (8, "http://net?x"),
    ]
    found = url_filter.judge_urls(spark.createDataFrame(urls, "page_id bigint, url string").withColumn("host", F.lit(1)), rules)
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted([
        (1, "a.net", "/x/y", "a.net/x/", "block"), (1, "a.net", "/x/y", "a.net/x/", "block"), (2, "w.b.net", "/", "b.net", "allow"),
        (3, "net", "/", "net/", "block"), (4, "", "", None, "allow"), (5, "", "", None, "allow"), (6, "xnet", "/", None, "allow"),
        (7, "a.net:80", "/x/", None, "allow"), (None, "c.net", "/", "net/", "block"), (8, "net", "", None, "allow"),
    ], key=str)
    assert url_filter.judge_urls(found.limit(0).withColumn("url", F.lit("")).select("page_id", "url"), rules).count() == 0


def test_ngram_join(docs, crowded, nothing):
    rows = ngram_join.similar_components(crowded).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert by[1] == (13, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (0, 4) and by[6] == (1, 6)
    assert by[8] == (1, 8) and by[None] == (1, None) and by[5] == (16, 5)
    assert ngram_join.similar_components(nothing).collect() == []
    assert {r.doc_id: r.component_id for r in ngram_join.similar_components(docs, 4, 80).collect()}[5] == 1


def test_large_groups_of_near_copies(spark, monkeypatch):
    """A hot group, cut in blocks, against brute force."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(90):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            words[at] = f"e{rng.integers(0, 40)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 4]) for i in range(117)} for t in texts]
    edges = [(a, b) for a in range(90) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = list(range(90))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar_components(docs).collect()} == {i: find(i) for i in range(90)}


def test_t_occurrence():
    rng = np.random.default_rng(1)
    for size in (5, 200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(1, size))) for _ in range(12)]
        for least in (1, 3, 7, 12):
            counts = {}
            for values in lists:
                for v in values.tolist():
                    counts[v] = counts.get(v, 0) + 1
            assert ngram_join.t_occurrence(lists, least) == {k: v for k, v in counts.items() if v >= least}


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 9), (6, 6), (1, 5)]
    found = components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert dict(map(tuple, found.collect())) == {**dict.fromkeys([1, 2, 3, 4, 5], 1), **dict.fromkeys([7, 8, 9], 7)}
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_tool_calls(spark):
    schemas = spark.createDataFrame([("f", "n", "integer", True), ("f", "s", "string", False), ("g", None, None, None)],
                                    "name string, field string, type string, required boolean")

    def call(**given):
        return json.dumps([given])

    rows = [
        (1, 0, "assistant", "hi", call(id="a", name="f", arguments={"s": "x", "n": 1}, after=["b"]), None),
        (1, 1, "assistant", None, call(id="b", name="f", arguments='{"n": 2}'), None),
        (1, 2, "tool", "R", None, "a"), (1, 3, "tool", "Q", None, "b"), (1, 4, "tool", "lost", None, "zz"),
        (1, 5, "assistant", "", call(id="a", name="f", arguments={"n": 1}), None),
        (2, 0, "assistant", "c", call(id="x", name="g", arguments={}, after=["y"]), None),
        (2, 1, "assistant", "d", call(id="y", name="g", arguments={"k": 1}, after=["x"]), None),
        (2, 2, "assistant", "e", call(id="w", name="f", arguments={"n": "1"}), None),
        (2, 3, "assistant", "e", call(id="v", name="none", arguments={}), None),
        (2, 4, "assistant", "e", "no json", None), (None, None, None, None, None, None),
    ]
    columns = "conv_id bigint, turn bigint, role string, content string, tool_calls string, tool_call_id string"
    messages = spark.createDataFrame(rows, columns)
    calls = {(r.conv_id, r.row - 1): r for r in tool_calls.link_calls(tool_calls.numbered(messages), schemas).collect()}
    assert {k: r.status for k, r in calls.items()} == {
        (1, 0): "ok", (1, 1): "ok", (1, 5): "repeated", (2, 0): "circular", (2, 1): "bad_arguments", (2, 2): "bad_arguments", (2, 3): "unknown_tool",
        (1, 4): "lost_result",
    }
    assert calls[1, 0].level == 1 and calls[1, 1].level == 0 and calls[1, 0].result == "R"
    assert calls[1, 0].arguments == '{"n":1,"s":"x"}' and calls[1, 1].arguments == '{"n":2}'
    chats = {r.conv_id: r for r in tool_calls.format_chats(messages, schemas).collect()}
    assert (chats[1].n_messages, chats[1].n_calls, chats[1].n_ok, chats[1].n_lost) == (3, 3, 2, 1) and chats[None].n_messages == 1
    for chat in chats.values():
        assert json.dumps(json.loads(chat.chat), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == chat.chat
    assert tool_calls.format_chats(messages.limit(0), schemas).collect() == []


def test_warc(spark, tmp_path):
    page = "p" * 1200
    rows = [(1, "http://a/", page), (3, None, page), (2, "http://b/\r\nX: y", page), (3, None, page), (4, "u", None), (5, "u", "ü\0\r\n\r\n"), (None, "u", page)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_archives(warc.plan_records(pages), folder, file_bytes=200)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 1
    back = warc.read_archives(manifest, folder).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in back)
    assert kinds == [(0, "revisit", 3, 1200), (1, "revisit", 3, 1200), (2, "revisit", 3, 1200), (3, "response", None, 1200),
                     (3, "response", None, 1200), (4, "response", None, 0), (5, "response", None, 7)]
    assert all(r.intact for r in back)
    assert next(bytes(r.payload) for r in back if r.page_id == 5) == "ü\0\r\n\r\n".encode()
    for row in manifest.collect():
        assert gzip.open(row.file).read(8) == b"WARC/1.1"
    assert warc.archived(pages.limit(0), folder).collect() == []


def test_damaged_archives_are_noticed():
    record = warc.format_record(1, "u", b"payload", "0" * 40, None, False)
    assert not list(warc.read_records(io.BytesIO(warc.gzip_member(record))))[0][-1]
    with pytest.raises(warc.RecordError):
        list(warc.read_records(io.BytesIO(warc.gzip_member(record)[:-20])))
    with pytest.raises(warc.RecordError):
        list(warc.read_records(io.BytesIO(warc.gzip_member(record + b"more"))))


def _weighted(bits: list[tuple[bytes, int]], level: int, depth: int) -> float:
    """Log of the weighted probability of decisions, each with the context before it."""
    ones = sum(bit for _, bit in bits)
    own = math.lgamma(len(bits) - ones + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(len(bits) + 1)
    if level == depth:
        return own
    groups = {}
    for past, bit in bits:
        groups.setdefault(past[-1 - level], []).append((past, bit))
    below = sum(_weighted(group, level + 1, depth) for group in groups.values())
    return np.logaddexp(math.log(0.5) + own, math.log(0.5) + below)


def _code_length(training: list[str], text: str, depth: int) -> float:
    """Log10 of the text's probability: ratios of weighted probabilities, by recursion."""

    def framed(t: str) -> list[tuple[bytes, int]]:
        frame = bytes(depth) + t.encode() + b"\xff"
        return [(frame[i - depth : i], frame[i]) for i in range(depth, len(frame))]

    nodes = {}
    for t in training:
        for past, byte in framed(t):
            for k in range(7, -1, -1):
                nodes.setdefault((byte | 256) >> (k + 1), []).append((past, (byte >> k) & 1))
    log = 0.0
    for past, byte in framed(text):
        for k in range(7, -1, -1):
            seen = nodes.get((byte | 256) >> (k + 1), [])
            now = _weighted([*seen, (past, (byte >> k) & 1)], 0, depth)
            log += now - (_weighted(seen, 0, depth) if seen else 0.0)
    return log / math.log(10)


@pytest.mark.parametrize("depth", [0, 2, 4])
def test_tree_equals_sequential_weighting(spark, depth):
    """Whole-text scores, of seen and unseen contexts, for any number of looked-up grams."""
    texts = {1: "abracadabra abra", 2: "abra cabra", 3: None, 4: "zebra \u00e9", 5: "abracadabra cab", 6: "cab abra", 9: "bar"}
    rows = [(i, t) for i, t in texts.items()] + [(1, texts[1])]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    assert True in held.values() and False in held.values()
    training = [t or "" for i, t in rows if not held[i]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = {i: _code_length(training, t or "", depth) for i, t in texts.items()}
    for head in (0, 5, 1000):
        found = lm_scoring.lm_scores(docs, depth, head_grams=head).collect()
        assert len(found) == len(rows)
        for row in found:
            assert row.score == pytest.approx(expected[row.doc_id], rel=1e-9)


def test_tree_depth_is_bounded(docs):
    with pytest.raises(ValueError, match="64-bit"):
        lm_scoring.lm_scores(docs, depth=lm_scoring.MOST_DEPTH + 1)


def test_lm_scores(docs, crowded, nothing):
    rows = lm_scoring.lm_scores(crowded, head_words=3).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows}
    assert by[2].n_tokens == by[3].n_tokens == by[4].n_tokens == 1 and by[2].score == by[3].score
    few = {(r.doc_id, r.n_tokens): r.base_score for r in rows}
    many = {(r.doc_id, r.n_tokens): r.base_score for r in lm_scoring.lm_scores(docs, head_words=1000).collect()}
    assert few == pytest.approx(many)
    assert lm_scoring.lm_scores(nothing).collect() == []


def test_mixing(docs, crowded, nothing):
    rows = mixing.mix_plan(crowded).collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    copies = mixing.mixed(crowded)
    assert copies.columns.count("copy") == 1 and set(crowded.columns) == set(copies.columns)
    words = sum(len((r.text or "").split()) for r in copies.collect())
    assert words == sum(r.taken for r in rows)
    assert mixing.mix_plan(nothing).collect() == [] and mixing.mixed(nothing).collect() == []
    assert sorted(map(tuple, mixing.mix_plan(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 50), ("c", 0)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5 for a, b, c, none: a and none are full, b takes the rest.
    assert found == pytest.approx({"a": 20.0, "c": 0.0, None: 100.0, "b": 120.0})


def test_pipeline(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(6, "word of the bench that nobody holds")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(6, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "source_mix":
            assert now.columns == docs.columns
    texts = [r.text for r in now.collect()]
    assert texts.count(LONG) <= 2 and len(corpus_pipeline.STAGES) == 5


def test_pipeline_keeps_columns_of_any_name(spark, docs):
    own = docs.withColumns({name: F.lit("own") for name in ("_removed", "_Sentences", "_sentences_")})
    kept = dict(corpus_pipeline.STAGES)["substring_dedup"](spark, own, "")
    assert kept.columns == own.columns
    assert {(r._removed, r._Sentences, r._sentences_) for r in kept.collect()} == {("own", "own", "own")}


def test_pipeline_stages_decide(spark):
    """Stage by stage on given tables: what goes is what the operators find, nothing else."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["ngram_jaccard_join"](spark, docs, sf).collect()}
    groups = ngram_join.similar_components(docs, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT).collect()
    assert kept == {r.doc_id for r in groups if r.component_id == r.doc_id}
    clean = {r.doc_id for r in stages["benchmark_decontamination"](spark, docs, sf).collect()}
    hits = decontamination.contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert clean == {r.doc_id for r in hits if not r.contaminated} and len(clean) < docs.count()
