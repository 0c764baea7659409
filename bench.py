"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
Every query is run to the end with its full result written to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bibspark.operators import sorting  # noqa: E402
from bibspark.plans.pubview import publications  # noqa: E402
from bibspark.plans.queries import QUERIES  # noqa: E402
from bibspark.session import clear_work_folder, get_session  # noqa: E402

HEADLINE = [
    "sorted_titles", "sorted_authors", "sorted_years", "year_histogram", "year_buckets",
    "unify_records", "duplicate_files", "bib_roundtrip",
    "type_by_year", "top_authors", "top_journals",
    "keyword_freq", "cooccurrence_graph",
    "ngram_vocabulary", "tfidf_weights", "most_similar", "corpus_similarity",
    "cosine_pairs", "agglomerate_average", "top_neighbours",
]


def sort_titles(spark, sf):
    """The plain sort, without numbering: the counterpart of an in-memory list sort."""
    return sorting.sorted_field(publications(spark, sf), "title")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    # the same on the next smaller tables first: the warm-up, and the base of the growth factors
    small = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
    runs = {"sort_titles_plain": sort_titles, **{name: QUERIES[name] for name in HEADLINE}}
    before: dict[str, float] = {}
    times: dict[str, float] = {}
    for tables, folder in ((before, small), (times, sf)):
        for name, query in runs.items():
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            tables[name] = round(time.perf_counter() - start, 3)
            print(f"{folder} {name}: {tables[name]}", file=sys.stderr, flush=True)
    clear_work_folder(spark)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "growth": {name: round(times[name] / before[name], 2) for name in times},
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
