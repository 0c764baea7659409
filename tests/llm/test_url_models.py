"""The url models against plain counts, with n-grams and contexts that are rare among the training characters."""

import math
import random
import zlib
from collections import Counter

from bibspark.llm import urls


def ratios(train, asked):
    """The ratio of each asked (host, path), with models of (host, path, accepted)."""
    counts = {True: Counter(), False: Counter()}
    text = lambda host, path: "^" * urls.ORDER + host + path + "$"
    for host, path, accepted in train:
        t = text(host, path)
        for i in range(urls.ORDER, len(t)):
            for k in range(urls.ORDER + 1):
                counts[accepted]["g", t[i - k : i + 1]] += 1
                counts[accepted]["x", k, t[i - k : i]] += 1
    out = []
    for host, path in asked:
        t, total = text(host, path), 0.0
        for i in range(urls.ORDER, len(t)):
            p = {True: 1 / urls.ALPHABET, False: 1 / urls.ALPHABET}
            for k in range(urls.ORDER + 1):
                n = {c: counts[c]["x", k, t[i - k : i]] for c in p}
                if n[True] + n[False]:
                    p = {c: (counts[c]["g", t[i - k : i + 1]] + urls.SMOOTHING * p[c]) / (n[c] + urls.SMOOTHING) for c in p}
            total += math.log(p[True]) - math.log(p[False])
        out.append(total / (len(t) - urls.ORDER))
    return out


def test_ratio_counts_rare_ngrams(spark):
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(12))
    rows = [(f"{name()}.com", f"/{name()}", True) if k % 10 else (f"{name()}.net", f"/es/{name()}", False) for k in range(12000)]
    url = lambda host, path: f"https://{host}{path}"
    train = [r for r in rows if zlib.crc32(url(*r[:2]).encode()) % urls.CALIBRATION]
    assert sum(len(h) + len(p) + 1 for h, p, _ in train) > 200000  # counts of 1 are below 1e-5 of that, 20 below 1e-4
    asked = [(f"{rows[k][0][:-4]}.org", rows[k + 1][1]) for k in range(0, 200, 5)] + [("", "/en/x"), ("", "/es/y"), ("", "")]
    table = [(-1, url(h, p)) for h, p, _ in rows] + [(k, url(*a)) for k, a in enumerate(asked)]
    table += [(len(asked) - 1, None), (len(asked) - 1, "no scheme/es/x")]  # no host and no path, as the last one
    found = urls.judge_urls(spark.createDataFrame(table, "page_id long, url string")).where("page_id >= 0").collect()
    expected = ratios(train, asked)
    assert len(found) == len(asked) + 2 and all(abs(r.ratio - expected[r.page_id]) < 1e-9 for r in found)
    limit = threshold([r for r in rows if zlib.crc32(url(*r[:2]).encode()) % urls.CALIBRATION == 0], train)
    assert {r.verdict for r in found} == {"allow", "block"}
    assert all(r.verdict == ("allow" if expected[r.page_id] >= limit else "block") for r in found)


def threshold(calibration, train):
    """The multiple of the bin width that parts the calibration urls best, the nearest to 0 of several."""
    scores = list(zip(ratios(train, [r[:2] for r in calibration]), (r[2] for r in calibration)))
    kinds = {k: [max(-200, min(200, math.floor(s / urls.BIN))) for s, own in scores if own == k] for k in (True, False)}
    low, high = min(map(min, kinds.values())), max(map(max, kinds.values()))
    cost = {t: sum(b < t for b in kinds[True]) / len(kinds[True]) + sum(b >= t for b in kinds[False]) / len(kinds[False]) for t in range(low, high + 2)}
    return urls.BIN * min((t for t in cost if cost[t] <= min(cost.values()) + 1e-12), key=abs)
