"""Time the headline queries; prints one JSON line.

Each query's plan is built and its whole result is produced (a no-op write), so that column
pruning cannot skip the work. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from catalog import tables as t
from proxysift import AnalysisParams, JobParams, build_session
from proxysift import operators as op
from proxysift.plans import detect_anomalies, run_job
from proxysift.session import durable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FIT = AnalysisParams(iterations=20)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": Path(tempfile.mkdtemp(prefix="bench-")).as_uri(),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Inputs as files, as a user would have them; not part of any timing.
    records_path = t.scratch_path(spark, "records")
    lines_path = t.scratch_path(spark, "lines")
    t.proxy_view(spark, SF_DIR).repartition(int(CPUS)).write.parquet(records_path)
    t.raw_lines(spark, SF_DIR).repartitionByRange(int(CPUS), "value").write.text(lines_path)
    ranked = durable(t.ranked(spark, SF_DIR))

    def records():
        return op.clean_records(spark.read.parquet(records_path))

    agents = durable(op.agent_counts(records()))
    words = durable(op.with_words(records(), ranked, agents))
    counts = durable(op.document_word_counts(words))
    dictionary = durable(op.word_dictionary(counts))
    size = dictionary.count()
    mix, probs = t.fixed_mix(spark, SF_DIR), t.fixed_probs(words)
    corpus = durable(op.vector_corpus(counts, dictionary, size))
    documents = corpus.persist().count()

    def ingest() -> None:
        run_job(spark, JobParams("Proxy", in_path=lines_path, out_path=t.scratch_path(spark, "out")))

    runs: dict[str, Callable[[], None]] = {
        "clean_records": lambda: consume(records()),
        "ingest_job": ingest,
        "word_creation": lambda: consume(
            op.with_words(records(), ranked, durable(op.agent_counts(records())))
        ),
        "client_word_counts": lambda: consume(
            op.document_word_counts(op.with_words(records(), ranked, agents))
        ),
        "corpus_building": lambda: consume(
            op.vector_corpus(counts, op.word_dictionary(counts), size)
        ),
        "model_fit_20": lambda: op.fit_topics(corpus, documents, FIT),
        "scoring": lambda: consume(
            # Stored before the sort, as the job does it: a range sort reads its input twice.
            op.least_likely_first(durable(op.filter_suspicious(op.score_records(words, mix, probs, t.TOPICS))))
        ),
        "anomaly_detection": lambda: consume(detect_anomalies(records(), ranked, FIT)),
    }
    seconds = {}
    for name, run in runs.items():
        run()  # warm-up
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
