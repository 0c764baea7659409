"""Run the operators' queries over a folder of tables and hold them against the plain versions.

``python tests/llm/oracle_check.py SF_DIR [op ...]``
"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import brute  # noqa: E402

COMPARED = {
    "op1_ngram_jaccard_join": (brute.jaccard, "doc_id n_shingles component_id"),
    "op2_quality_rules": (brute.quality, "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed"),
    "op4_substring_dedup": (brute.substrings, "doc_id n_words n_removed kept_sha256"),
    "op7_license_scan": (brute.base_licenses, "doc_id n_words n_base first_word last_word base_labels"),
    "op8_lm_scoring": (brute.unigram, "doc_id held_out n_tokens n_known train_tokens base_score"),
    "op10_token_counts": (brute.token_counts, "doc_id n_bytes n_tokens over_limit"),
}


def rounded(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


def main():
    from bibspark.llm.queries import QUERIES
    from bibspark.session import get_session

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            mine = df.toPandas()
            took = time.time() - start
            compare, columns = COMPARED.get(name, (None, ""))
            if name.startswith("op3"):
                compare, columns = (lambda rows: brute.contamination(rows, items)), "doc_id n_words n_hit n_items items_sha256 contaminated"
            if compare:
                a, b = rounded(tuple(r) for r in df.select(*columns.split()).collect()), rounded(compare(docs))
                bad = [(x, y) for x, y in zip(a, b) if x != y]
                verdict = f"ok ({len(a)})" if a == b else f"DIFFERENT {len(a)} {len(b)} {len(bad)} first {bad[:2]}"
            else:
                verdict = f"{len(mine)} rows"
            print(f"{name}: {verdict} [{took:.1f}s]\n{mine.head(3).to_string()}", flush=True)
        except Exception as error:
            print(f"{name}: FAILED {str(error)[:3000]}", flush=True)


if __name__ == "__main__":
    main()
