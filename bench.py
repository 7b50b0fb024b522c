"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from pressmark.session import local_session  # noqa: E402

HEADLINES = (
    "article_rows", "article_fields", "archive_links", "import_shards", "render_markdown", "front_matter_parse",
    "ascii_fold", "tfidf_weights", "confusion_by_label", "metrics_macro", "metrics_micro", "kfold_assign",
    "classify_documents", "kfold_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # one small run starts the workers and compiles what all queries share
    QUERIES["url_slug"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
