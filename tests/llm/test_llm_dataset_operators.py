"""Exact dedup, manifest and divergence audit against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F
from wageledger.llm import divergence, exact_dedup, manifest

FOLDER = "/root/testdata/sf0.001"
# columns that the operators use inside
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, rep int, h string, gid int, pos int, term string, n int, key int"
LONG = " ".join(f"Ab{i % 977}x{i % 13}é" for i in range(60_000))


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "h", 3, 4, "t", 5, 6) for r in rows], DOCS)


def hard_rows():
    rng = random.Random(2)
    texts = [None, "", " ", "\t\n", " a", "a ", "a", "a  b", "a\n\tb", "a b", "a b", "A b", LONG, LONG.replace(" ", "\n"), "\x00", "ß É é"]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", i) for i, t in enumerate(texts)]
    rows += [(100 + i, "hot copy", "en", "hot", 8) for i in range(300)]
    rows += [(rng.randrange(1000), rng.choice(texts[:12]), rng.choice(["en", "de", "", None]), rng.choice(["a", "b", "é", "", None]), None) for _ in range(300)]
    rows += [(None, t, "en", "a", 1) for t in texts[:4]] + [(None, "only null ids", "en", "a", 1)] * 2
    return rows + rows[-3:] + rows[300:303]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 1 << 12, 40])
def test_exact_groups_equal_brute_force(spark, table_bytes):
    """The small tables force several levels of partitioning, and merges of the hot copies."""
    rows = hard_rows()
    by_text = defaultdict(list)
    for r in rows:
        by_text[norm(r[1])].append(r[0])
    want = []
    for text, ids in by_text.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    frame = docs(spark, rows).repartition(64)
    got = exact_dedup.groups(frame, table_bytes=table_bytes).drop("carried").collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    stay = exact_dedup.deduplicate(frame, table_bytes=table_bytes)
    assert stay.columns == frame.columns
    assert sorted(norm(r.text) for r in stay.collect()) == sorted(by_text)


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable()
    rng = random.Random(4)
    contents = [rng.randbytes(rng.randrange(3)) for _ in range(5000)]
    numbers = [table.number(len(c) % 2 - 1, c) for c in contents]  # two hashes, one of them negative
    firsts = {}
    assert numbers == [firsts.setdefault(c, len(firsts)) for c in contents]


def test_one_hash_of_many_contents_is_cut_again(spark, monkeypatch):
    """Contents that share their first hash are told apart by the next."""
    plain = exact_dedup._hash
    monkeypatch.setattr(exact_dedup, "_hash", lambda content, seed: 7 if seed == 0 else plain(content, seed))
    frame = spark.createDataFrame([(i, f"text {i % 400}") for i in range(1000)], "doc_id long, text string").repartition(4)
    got = exact_dedup.groups(frame, table_bytes=200).select("doc_id", "keep_id", "group_size").collect()
    assert all(r.keep_id == r.doc_id % 400 and r.group_size == (3 if r.keep_id < 200 else 2) for r in got) and len(got) == 1000


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def flanks(levels, at):
    for level in levels[:-1]:
        start = at // 16 * 16
        yield "".join(level[start:at]), "".join(level[at + 1 : start + 16])
        at //= 16


def brute_manifest(rows):
    leaf = lambda r: digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    lower = lambda t: t and "".join(c.lower() if c.isascii() else c for c in t)
    by_source = defaultdict(list)
    for i, t, lang, source, n in rows:
        changed = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        by_source[source].append((i is not None, i or 0, leaf((i, source, lang, n, t)), i, leaf((i, source, lang, n, lower(t))) if changed else None))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    top = climb([trees[s][-1][0] for s in sources])
    for k, s in enumerate(sources):
        for at, (_, _, mine, i, tampered) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = [*flanks(trees[s], at), *flanks(top, k)]
            node = tampered or mine
            for left, right in path:
                node = digest(left + node + right)
            yield (i, mine, trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), node, node == top[-1][0])


def run(spark, tmp_path, name, frame):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    return contract.queries()[name](spark, str(tmp_path))


@pytest.mark.parametrize(
    "rows",
    [
        hard_rows(),
        # more than a block, exactly a block and a run, one more and one less, many sources
        [(i, f"T{i}", "en", s, i) for s, n in (("a", 600), ("b", 256), ("c", 257), ("d", 16), ("e", 17), ("f", 1), (None, 15)) for i in range(n)]
        + [(i, "x", "en", f"s{i:03d}", None) for i in range(300)],
        [(5, "Lone", "en", "s", 1)],
        [(i, None, None, None, None) for i in range(4200)],
    ],
    ids=["hard", "sizes", "lone", "three_levels"],
)
def test_manifest_equals_brute_force(spark, tmp_path, rows):
    got = run(spark, tmp_path, "op12_merkle_manifest", docs(spark, rows)).collect()
    assert sorted(map(repr, brute_manifest(rows))) == sorted(repr(tuple(r)) for r in got)


def test_manifest_lists_its_groups(spark):
    leaves = spark.range(40).select((F.col("id") % 2).alias("source"), "id", F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    tree = manifest.build(leaves, "source", "id", "leaf", F.col("id"))
    want = [(s, 20, climb([digest(str(i)) for i in range(s, 40, 2)])[-1][0]) for s in (0, 1)]
    assert sorted(tuple(r) for r in tree.groups.collect()) == want
    assert tree.root == climb([w[2] for w in want])[-1][0]


def brute_divergence(rows, least):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        counts[lang, source].update(found)
        seen[lang].update(set(found))
        groups.add((lang, source))
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in seen[lang].items() if n >= least}
        sources = sorted(s for g, s in groups if g == lang)

        def prices(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {s: prices(counts[lang, s]) for s in sources}
        q = prices(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [("pair", o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            over = [("term", t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, top in ((pairs, len(pairs)), (over, 50)):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                yield from ((lang, s, *x, rank) for rank, x in enumerate(part[:top], 1))


@pytest.mark.parametrize("least, bits", [(2, 14), (2, 1), (30, 14), (10**6, 14)])
def test_divergence_equals_brute_force(spark, monkeypatch, least, bits):
    """Slices of two ids force many arrays per group; the last bound keeps no term."""
    monkeypatch.setattr(divergence, "SLICE", 1 << bits)
    monkeypatch.setattr(divergence, "HELD", 100)
    monkeypatch.setattr(divergence, "BROADCAST", 0 if bits == 1 else divergence.BROADCAST)
    rng = random.Random(6)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)] + ["ÉÀ", "É", "Q"]
    rows = hard_rows() + [
        (i, " ".join(rng.choices(vocabulary[: rng.randrange(1, 147)], k=rng.randrange(40))), rng.choice(["en", "de"]), f"s{rng.randrange(5)}", 0) for i in range(300)
    ]
    got = divergence.audit(docs(spark, rows), least=least).collect()
    assert sorted(map(repr, brute_divergence(rows, least))) == sorted(repr(tuple(r)) for r in got)


def test_prices_are_exact_in_long_ranges():
    for total in (10, 10**6 + 3, 9 * 10**15, 10**17):
        count = np.array([0, 1, 5, total // 3, total - 5], np.int64)
        assert [int(x) for x in divergence.prices(count, total)] == [1 + 10**9 * (int(c) + 5) // total for c in count]


def test_gallop_finds_places():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 100, 1000):
        long = np.unique(rng.integers(0, 2 * n, n))
        short = np.unique(rng.integers(-2, 2 * n + 2, 30))
        assert (divergence.gallop(short, long) == np.searchsorted(long, short)).all()


@pytest.mark.parametrize("name", ["op11_exact_groups", "op12_merkle_manifest", "op13_source_divergence"])
def test_empty_tables(spark, tmp_path, name):
    df = run(spark, tmp_path, name, docs(spark, []))
    assert df.collect() == [] and not any(kind == "void" for _, kind in df.dtypes)


@pytest.mark.parametrize("name", ["op11_exact_groups", "op12_merkle_manifest", "op13_source_divergence"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    result = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = contract.queries()[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([row[names.index(c)] for c in df.columns]) for row in result.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == want
