"""The manifest against a tree built in plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gazette.llm import merkle
from gazette.llm.common import prepare
from tests.llm import data as D


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def tree(nodes):
    """All levels, from the nodes up to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i:i + 3])) for i in range(0, len(row), 3)])
    return levels


def way(levels, i):
    """(place in the run, others) a level."""
    out = []
    for row in levels[:-1]:
        run = row[i - i % 3:i - i % 3 + 3]
        out.append((i % 3, [x for k, x in enumerate(run) if k != i % 3]))
        i //= 3
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), text
    without line ends in rows of even crc32."""
    import zlib
    low = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    sources = sorted({r[3] for r in rows}, key=low)
    trees, members = [], []
    for s in sources:
        mine = sorted(((r[0], leaf(r[0], r[3], r[2], r[4], r[1]), r) for r in rows if r[3] == s), key=lambda x: (low(x[0]), x[1]))
        members.append(mine)
        trees.append(tree([x[1] for x in mine]))
    over = tree([t[-1][0] for t in trees])
    out = []
    for g, (mine, t) in enumerate(zip(members, trees)):
        for i, (doc, h, r) in enumerate(mine):
            steps = way(t, i) + way(over, g)
            told = h
            if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                told = leaf(r[0], r[3], r[2], r[4], None if r[1] is None else r[1].replace("\n", ""))
            for place, others in steps:
                told = sha("".join([*others[:place], told, *others[place:]]))
            root = over[-1][0]
            out.append((doc, h, t[-1][0], root, sha("".join(x for _, o in steps for x in o)), told, told == root))
    return out


def proofs(docs, height):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    whole = [F.col(c) for c in merkle.COLUMNS]
    made = merkle.manifest(docs, keep={"tampered": F.when(even, merkle.leaf(*whole[:-1], F.replace("text", F.lit("\n"), F.lit(""))))}, height=height)
    hexed = lambda c: F.lower(F.hex(c))
    rows = made.proofs(F.coalesce("tampered", "digest")).select("key", hexed("digest"), hexed("subroot"), hexed("root"), F.sha2(hexed("proof"), 256), hexed("folded"),
                                                               F.col("folded") == F.col("root")).collect()
    return made, [tuple(r) for r in rows]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("height", [1, 2, 8])
def test_odd_rows(spark, height):
    prepare(spark)
    rows = [(*r, None if r[1] is None else len(r[1])) for r in D.texts()]
    made, got = proofs(D.frame(spark).repartition(3), height)
    assert order(got) == order(brute(rows))
    assert made.root().first()["root"] == brute(rows)[0][3]
    assert {r["value"]: r["subroot"] for r in made.subroots().collect()} == {r[3]: h for r in rows for d, _, h, *_ in brute([x for x in rows if x[3] == r[3]])}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_sizes_and_many_sources(spark, n):
    """A hot source and n others of one row each, over several tiers."""
    prepare(spark)
    rows = [(i, f"text\n{i}", "en", "hot") for i in range(2 * n)] + [(1000 + i, f"t{i}", None, f"s{i}") for i in range(n)]
    _, got = proofs(D.frame(spark, rows), 1)
    assert order(got) == order(brute([(*r, len(r[1])) for r in rows]))


def test_empty(spark):
    prepare(spark)
    made, got = proofs(D.empty(spark), 2)
    assert got == [] and made.root().count() == 0 and made.subroots().count() == 0


def test_tampering_shows(spark):
    prepare(spark)
    rows = [(i, "a line\nanother" if i % 2 else "one line", "en", "s") for i in range(40)]
    _, got = proofs(D.frame(spark, rows), 2)
    import zlib
    for doc, *_, verified in got:
        assert verified == (doc % 2 == 0 or zlib.crc32(str(doc).encode()) % 2 == 1)


@pytest.mark.parametrize("height", range(0, 7))
def test_layout_is_van_emde_boas(height):
    at = [merkle.level_addresses(level, height) for level in range(height + 1)]
    every = sorted(a for row in at for a in row)
    assert every == list(range(merkle.size_of(height)))
    assert at[height][0] == 0
    if height:
        # each bottom tree lies in one piece behind the top tree
        below = (height + 1) // 2 - 1
        for i in range(3 ** (height - below)):
            mine = sorted(a for level in range(below + 1) for a in at[level][i * 3 ** (below - level):(i + 1) * 3 ** (below - level)])
            assert mine == list(range(mine[0], mine[0] + len(mine))) and mine[0] >= merkle.size_of(height - below - 1)


def test_stored_block_reads_back():
    leaves = [bytes([i]) * 32 for i in range(20)]
    t = merkle.Layout.build(leaves, 3)
    again = merkle.Layout.read(t.bytes(), t.n, t.height)
    assert again.paths() == t.paths() and again.level(0) == leaves
    assert all(merkle.fold(d, p) == t.top for d, p in zip(leaves, again.paths()))
