"""The randomness battery and its thresholds against brute force."""

import math
import random
import re
import string
import time
from collections import Counter

from wageledger.llm import secrets

ALPHABETS = {
    "decimal": string.digits,
    "hex": string.digits + "abcdef",
    "upper_hex": string.digits + "ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "alphanumeric": string.ascii_uppercase + string.ascii_lowercase + string.digits,
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    "base64url": string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
}


def tail(z):
    return max(1e-12, math.erfc(z / math.sqrt(2)) / 2)


def brute_battery(run):
    """Encoding, length band and combined p of a run."""
    core = run.rstrip("=")
    encoding = next((e for e, a in ALPHABETS.items() if core and set(core) <= set(a)), None)
    if len(core) < 8 or not encoding:
        return None
    alphabet, n = ALPHABETS[encoding], len(core)
    size = len(alphabet)
    v = [alphabet.index(c) for c in core]
    seen, width = Counter(x * 8 // size for x in v), Counter(x * 8 // size for x in range(size))
    chi = sum((seen[c] - n * width[c] / size) ** 2 / (n * width[c] / size) for c in range(8))
    p1 = tail(((chi / 7) ** (1 / 3) - (1 - 2 / 63)) / math.sqrt(2 / 63))
    high = [2 * x >= size for x in v]
    ups, turns = sum(high), sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * ups * (n - ups) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    p2 = 2 * tail(abs((turns + 1 - mean) / math.sqrt(var) if var > 1e-9 else 6.0))
    avg = sum(v) / n
    square = sum((x - avg) ** 2 for x in v)
    r = sum((a - avg) * (b - avg) for a, b in zip(v, v[1:], strict=False)) / square if square else 1.0
    p3 = 2 * tail(abs((r + 1 / n) * math.sqrt(n)))
    half = -sum(math.log(min(1.0, p)) for p in (p1, p2, p3))
    return encoding, sum(n >= b for b in (32, 48, 96)), math.exp(-half) * (1 + half + half * half / 2)


def brute_scan(texts, rate=0.05):
    patterns = (
        (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    )
    base, runs = [], []
    for text in texts:
        mine = [(m.start(), k, m.end()) for k, (p, g, least) in enumerate(patterns) for m in re.finditer(p, text) if len(m[g]) >= least]
        free = [m for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text) if not any(s < m.end() and m.start() < e for s, _, e in mine)]
        base.append(mine)
        runs.append([(m.start(), m.end(), m[0]) for m in free])
    tested = {run: t for mine in runs for *_, run in mine if (t := brute_battery(run))}
    groups = {}
    for encoding, band, p in tested.values():
        groups.setdefault((encoding, band), []).append(p)
    least = {}
    for group, ps in groups.items():
        random_ = min(len(ps), 2 * sum(int(p * 20) >= 10 for p in ps))
        for b in range(1, 20):
            reported = sum(min(19, int(p * 20)) >= b for p in ps)
            if reported and max(0.0, reported - random_ * (1 - b / 20)) / reported <= rate:
                least[group] = b / 20
                break
    out = []
    for mine, free in zip(base, runs, strict=True):
        for start, stop, run in free:
            if run in tested and tested[run][2] >= least.get(tested[run][:2], 2):
                mine = [*mine, (start, 3, stop)]
        out.append(",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{s}:{e}" for s, k, e in sorted(mine)))
    return out


def listed(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.scan(rows).select("doc_id", secrets.listed("spans").alias("s")).collect()
    return [r.s for r in sorted(found, key=lambda r: r.doc_id)]


def corpus():
    rng = random.Random(8)
    draw = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    runs = [draw(a, n) for a in ALPHABETS.values() for n in (20, 24, 33, 50, 100) for _ in range(12)]
    runs += ["x" * n for n in (20, 40, 100)] + ["ab" * 30, string.ascii_lowercase * 2, "/usr/share/lib/some-folder/name-of-file", "the_quick_brown_fox_jumps_over"]
    runs += ["snake_case_name_" * 2, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "=" * 30, "a======================", "1234567890" * 3] * 3
    texts = [f"é{rng.choice(['', 'key ', 'password = '])}{r}{rng.choice([' end', chr(10), ''])} token: {draw('ab', 7)}" for r in runs]
    return [*texts, "", " ".join(runs), "AKIA" + draw(string.ascii_uppercase, 30) + " " + draw(string.ascii_letters, 40)]


def test_battery_equals_brute_force(spark):
    runs = sorted({m[0] for t in corpus() for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t)})
    rows = secrets.tested(spark.createDataFrame([(r,) for r in runs], "run string")).collect()
    want = {r: brute_battery(r) for r in runs}
    assert {r.run for r in rows if r.encoding} == {r for r, t in want.items() if t}
    for r in rows:
        if want[r.run]:
            encoding, band, p = want[r.run]
            assert (r.encoding, r.band) == (encoding, band) and abs(r.p - p) < 1e-5


def test_random_spans_equal_brute_force(spark):
    texts = corpus()
    got = listed(spark, texts)
    assert got == brute_scan(texts)
    assert sum("random" in s for s in got) > 100


def test_text_is_never_random(spark):
    """Not even a group of text alone, where no threshold keeps the share of text down."""
    texts = ["x" * 40, "ab" * 30, string.ascii_lowercase * 2, "1" * 24, "Z" * 100]
    assert not any("random" in s for s in listed(spark, texts))


def test_plan_does_not_grow_with_findings(spark):
    def size(texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return len(secrets.scan(rows)._jdf.queryExecution().optimizedPlan().toString())

    assert size(corpus()) < 2 * size(["nothing here"]) < 50_000


def test_many_hits_and_a_long_text(spark):
    many = " ".join(f"token=abcdef{i}" for i in range(20_000))
    long = "x " * 2_000_000 + "AKIA" + "B" * 20
    listed(spark, ["warm up token=abcdef"])
    start = time.perf_counter()
    got = listed(spark, [many, long])
    assert time.perf_counter() - start < 20
    assert got[0] == brute_scan([many])[0] and got[1] == "access:4000000:4000024"
