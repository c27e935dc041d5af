"""Operators against brute force where an earlier form did less than the whole job."""

import numpy as np

from proxysift.llm import fingerprints, span_dedup, toxicity
from proxysift.llm.queries import QUERIES


def _full(run):
    words = sum(len(sentence.split()) for sentence in run)
    return words >= 40 or (len(run) >= 3 and words >= 15)


def _without_repeats(documents):
    """Documents (lists of sentences) without those that any full run of an earlier place covers."""
    seen, out = set(), []
    for document in documents:
        gone = set()
        for start in range(len(document)):
            for stop in range(start + 1, len(document) + 1):
                run = tuple(document[start:stop])
                if _full(run):
                    if run in seen:
                        gone.update(range(start, stop))
                    seen.add(run)
        out.append(([s for i, s in enumerate(document) if i not in gone], len(gone)))
    return out


def test_whole_passages_are_removed(spark):
    rng = np.random.default_rng(7)
    word = iter(range(10**6))

    def sentence(size):
        return " ".join(f"w{next(word)}" for _ in range(size)) + "."

    sizes = [[20, 20, 12], [45, 10], [10, 45], [2, 3, 41, 1], [6, 6, 6, 30], [38, 1, 1], [4, 4, 4], [2, 2, 2, 2, 20]]
    sizes += [rng.integers(1, 50, rng.integers(1, 7)).tolist() for _ in range(40)]
    passages = [[sentence(n) for n in lengths] for lengths in sizes]
    documents = []
    for copy in range(2):
        for passage in passages:
            around = [[sentence(n) for n in rng.integers(1, 30, 3)] for _ in range(2)]
            documents.append(around[0] + passage + around[1])
    documents.append(passages[2] + passages[2] + passages[3][:3])
    docs = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(documents)], "doc_id bigint, text string")
    rows = {row.doc_id: row for row in span_dedup.without_repeated_spans(docs).collect()}
    for i, (kept, gone) in enumerate(_without_repeats(documents)):
        assert (rows[i].text, rows[i].n_removed) == (" ".join(kept), gone)
    for i, passage in enumerate(passages):
        assert rows[len(passages) + i].n_removed == (len(passage) if _full(passage) else 0)


def test_fingerprints_have_64_samples(spark):
    """Also: an edited text has the fingerprint that the same text has as a document."""
    rows = QUERIES["op1_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    assert {len(r.fingerprint) for r in rows} <= {0, 64 * 8} and len(rows) == 200
    texts = {1: "a b b c c c " * 9 + "d e", 2: "", 3: "c a zz " * 5, 4: "q", 5: "    x"}
    order = sorted(texts, reverse=True)
    edited = {}
    for doc, after in zip(order, order[1:] + order[:1], strict=True):
        third = len(texts[doc]) // 3
        edited[doc] = texts[doc][: len(texts[doc]) - third] + texts[after][:third]

    def prints(given):
        return {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(list(given.items()), "doc_id bigint, text string")).collect()}

    first, second = prints(texts), prints(edited)
    assert {d: r.edited_fingerprint for d, r in first.items()} == {d: r.fingerprint for d, r in second.items()}
    assert first[2].fingerprint == "" and all(len(first[d].fingerprint) == 512 for d in (1, 3, 4, 5))


def test_chain_learns_from_every_token_of_the_sample(monkeypatch):
    """Long toxic texts, more clean texts than toxic ones, scripts that sort last."""
    rows = [(" ".join(f"you idiot u{i}n{k}" for k in range(700)), 1) for i in range(12)]
    rows += [(f"fine{i} day{i} there{i}", 0) for i in range(40)] + [(f"хороший{i} день{i} вам{i}", 0) for i in range(40)]
    seen = []
    fit_chain = toxicity._fit_chain

    def watched(texts, labels, lexicon):
        seen.extend(zip(texts, labels, strict=True))
        return fit_chain(texts, labels, lexicon)

    monkeypatch.setattr(toxicity, "_fit_chain", watched)
    tagger = toxicity.fit(rows)
    assert sorted(w for words, _ in seen for w in words) == sorted(w for text, _ in rows for w in toxicity.tokens(text))
    assert all(0 < len(words) == len(label) <= toxicity.CHAIN_TOKENS for words, label in seen)
    assert sum(label.sum() for _, label in seen) >= 12 * 700
    assert tagger.emission("idiot") > 0 > tagger.emission("хороший1")


def test_one_text_per_sampled_id_reaches_the_driver(spark, monkeypatch):
    rows = [(1, f"copy {i} of many") for i in range(300)] + [(2, "a single text"), (3, None), (4, "not labelled")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    found = []
    monkeypatch.setattr(toxicity, "fit", lambda given: found.append(sorted(given, key=str)))
    toxicity.train(docs, labels)
    toxicity.train(docs.repartition(3), labels)
    assert len(found[0]) == 3 and found[0] == found[1]
    assert {(text, toxic) for text, toxic in found[0] if toxic == 0} == {("a single text", 0), (None, 0)}


def test_an_id_on_a_third_of_all_rows(spark):
    """Its rows fill several buckets, each row is fingerprinted once, and neighbours follow on."""
    rows = [(i if i % 3 else 7, f"text number {i} of word{i % 11} and word{i % 5} w{i}") for i in range(1200)]
    docs = spark.createDataFrame([*rows, *rows[:20]], "doc_id bigint, text string")
    dealt = fingerprints.neighbours(docs, 16)
    sizes = {r.bucket: r["count"] for r in dealt.groupBy("bucket").count().collect()}
    assert max(sizes.values()) < 3 * sum(sizes.values()) / len(sizes) and len(sizes) >= 12
    assert dealt.where("guest = 1").count() <= len(sizes) + 20
    lined = dealt.where("guest = 0").collect()
    assert len(lined) == 1220
    order = sorted(lined, key=lambda r: (-r.key, r.hash, r.text.encode()))
    assert all(a.next_text == b.text for a, b in zip(order, [*order[1:], order[0]], strict=True))
    # Whole buckets in order: ids fall, hashes rise.
    assert [r.bucket for r in order] == sorted(r.bucket for r in order)
    assert fingerprints.fingerprints(docs, 8).count() == 1220


def test_values_of_frequent_pairs_are_those_of_any_other(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{i * k % 13}" for k in range(i % 400))) for i in range(60)], "doc_id bigint, text string"
    )

    def run():
        return sorted(map(tuple, fingerprints.fingerprints(docs, 16).collect()))

    whole = run()
    monkeypatch.setattr(fingerprints, "TERMS", 1)
    assert whole == run()


def test_texts_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    text = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "EvalPython" not in text and "SortMergeJoin" not in text
