"""op11: the manifest against a plain tree, with blocks of several sizes."""

import hashlib
import zlib

import llm_cases as C
import pytest
from oracle_harness import compare, duck

from tagloom.llm import merkle, oracle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """Root, and (left, right) siblings of every leaf level by level."""
    proofs, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run = nodes[p // 8 * 8 : p // 8 * 8 + 8]
            proofs[k].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
            place[k] = p // 8
        nodes = [H(*nodes[a : a + 8]) for a in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute(rows):
    """Result rows for (doc_id, source, lang, n_chars, text) rows."""

    def leaf(*values):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    langs = {}
    for d, s, lang, n, text in rows:
        changed = text
        if d is not None and text is not None and zlib.crc32(str(d).encode()) % 3 == 0:
            changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        langs.setdefault(lang, []).append((d, leaf(d, s, lang, n, text), leaf(d, s, lang, n, changed)))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for x in order:
        langs[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([r[1] for r in langs[x]]) for x in order]
    root, crown = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for x, (subroot, proofs), upper in zip(order, trees, crown):
        for (d, own, now), proof in zip(langs[x], proofs):
            for left, right in proof + upper:
                now = H(left, now, right)
            out.append((d, own, subroot, root, H(*(a + b for a, b in proof + upper)), now, now == root))
    return out


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.fixture(scope="module")
def expected():
    return sorted(brute(C.read("documents", ["doc_id", "source", "lang", "n_chars", "text"])), key=key)


@pytest.mark.parametrize("levels", [merkle.BLOCK_LEVELS, 1])
def test_equals_a_plain_tree(spark, expected, levels):
    docs = spark.read.parquet(f"{C.SF}/documents.parquet")
    got = sorted(map(tuple, merkle.manifest(docs, levels).collect()), key=key)
    assert got == expected
    assert {r[-1] for r in got} == {True, False}


def test_query_equals_sql(spark):
    name = "op11_merkle_butterfly"
    r = compare(spark, duck(C.SF), name, queries.QUERIES[name], oracle.ORACLE_SQL[name], C.SF)
    assert r["cols_match"] and r["values_match"], r


def test_sql_equals_a_plain_tree(expected):
    assert sorted(duck(C.SF).execute(oracle.OP11).fetchall(), key=key) == expected


@pytest.mark.parametrize("count", [1, 2, 8, 9, 17, 65, 130])
def test_sizes_around_the_fanout(spark, count):
    """One leaf a block, so the exchange makes every level, with short last runs and short last subtrees."""
    nodes = [H(str(i)) for i in range(count)]
    root, proofs = tree(nodes)
    frame = spark.createDataFrame([(t, i, n) for t, k in ((0, count), (5, 1)) for i, n in enumerate(nodes[:k])], "tree long, node long, digest string")
    got = merkle.butterfly(frame, "t").collect()
    whole = {r.node: r for r in got if r.tree == 0}
    assert len(got) == count + 1 and {r.digest for r in whole.values()} == {root}
    for i, proof in enumerate(proofs):
        assert [("".join(p.others[: p.place]), "".join(p.others[p.place :])) for p in whole[i].proof] == proof
    assert [(r.digest, r.proof) for r in got if r.tree == 5] == [(nodes[0], [])]


def test_awkward_and_empty(spark):
    rows = [(i, "s", lang, n, t) for k, (i, t) in enumerate(C.AWKWARD * 3) for lang, n in [(("é", None, "de", "")[k % 4], (None, k)[k % 2])]]
    docs = spark.createDataFrame([(i, t, lang, s, n, "x", "y") for i, s, lang, n, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string")
    for levels in (4, 1):
        assert sorted(map(tuple, merkle.manifest(docs, levels).collect()), key=key) == sorted(brute(rows), key=key)
    assert merkle.manifest(docs.limit(0)).collect() == []
    same = spark.createDataFrame([(3, "Same TEXT", "en", "s", 1)] * 100, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    assert sorted(map(tuple, merkle.manifest(same, 1).collect())) == sorted(brute([(3, "s", "en", 1, "Same TEXT")] * 100))
