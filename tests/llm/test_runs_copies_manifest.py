"""Periodic runs, exact copies and the manifest against plain versions, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlane.llm import exact_dedup, merkle_manifest, periodic_runs
from postlane.llm.queries import planted_repeats

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, runs string, node string, digest string"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        None, "", " \n\t\x0b\x0c\r ", "one", "a a a a a", "a a a a a a", "a b " * 30 + "c", "x y z é ​ É",
        "B" * 50_000, "w " * 20_000, "AbC d", "abc d", "A bCd", "same words here. " * 40, "same words here. " * 40,
    ]
    rows = [
        (at if at % 5 else None, text, None if at % 4 == 0 else f"l{at % 3}", None if at % 7 == 0 else "s", at or None, "r", "n", "d")
        for at, text in enumerate(texts)
    ]
    return spark.createDataFrame([*rows, rows[6], rows[5], rows[5], rows[5]], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and all(
                any(words[x] != words[x + d] for x in range(i, i + length - d)) for d in range(1, q)
            ):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(doc_id, text, rewrite):
    words = WORD.findall(text or "")
    words = plain_planted(doc_id, words) if rewrite else words
    runs = plain_runs(words)
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
        sha(" ".join(word for i, word in enumerate(words) if i not in dropped)),
    )


def key(row):
    return tuple((value is not None, value) for value in row)


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
@pytest.mark.parametrize("rewrite", [None, planted_repeats])
def test_runs(request, table, rewrite):
    df = request.getfixturevalue(table)
    if table == "docs":  # the plain version takes time that grows with the square of a text
        df = df.where("length(text) < 4000")
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(df, rewrite=rewrite))
    expected = [
        plain_digests(row.doc_id, row.text, rewrite) if len(row.text or "") < 30_000 else None
        for row in df.select("doc_id", "text").collect()
    ]
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    rows = [tuple(row) for row in got.collect()]
    assert len(rows) == len(expected)
    if table == "odd" and rewrite is None:
        assert sum(row[1:6] == (1, 0, 20_000, 1, 20_000_000) for row in rows) == 1
    short = [row for row in expected if row]
    assert all(sorted(rows, key=key).count(row) >= short.count(row) for row in short)


def test_runs_of_many_scales():
    rng = random.Random(7)
    for _ in range(60):
        texts = []
        for _ in range(3):
            n = rng.randint(0, 900)
            words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
            for _ in range(3 if n > 10 else 0):
                at, q = rng.randrange(n), rng.randint(1, n // 4)
                unit = words[at : at + q]
                if rng.random() < 0.5:  # a period that holds shorter runs
                    inner = rng.randint(1, len(unit))
                    unit = [unit[i % inner] if i < len(unit) // 2 else word for i, word in enumerate(unit)]
                for i in range(at, min(n, at + int(q * rng.uniform(3.5, 7)))):
                    words[i] = unit[(i - at) % len(unit)]
            texts.append(words)
        starts = np.concatenate(([0], np.cumsum([len(words) for words in texts]))).astype(np.int64)
        found = periodic_runs.runs_of(np.array(sum(texts, []), np.int64), starts)
        assert list(zip(*(column.tolist() for column in found))) == [
            (number, *run) for number, words in enumerate(texts) for run in plain_runs(words)
        ]


def test_long_periodic_texts():
    """Hot input for the seeds: one word, two words, a long period of nearly equal words."""
    unit = ([1] * 997 + [2]) * 3 + [3]
    for words, run in (
        ([5] * 300_000, (0, 0, 300_000, 1)),
        ([5, 6] * 150_000, (0, 0, 300_000, 2)),
        (unit * 60, (0, 0, 60 * len(unit), len(unit))),
    ):
        found = periodic_runs.runs_of(np.array(words), np.array([0, len(words)]))
        assert run in list(zip(*(column.tolist() for column in found)))


def plain_copies(rows):
    groups = defaultdict(list)
    for at, row in enumerate(rows):
        text = row.text or ""
        groups[sha(re.sub(r"[\x20\x09-\x0D]", "", text))].append((-len(text), row.doc_id is None, row.doc_id or 0, at))
    out = []
    for digest, members in groups.items():
        best = min(members)
        for member in members:
            doc_id = None if member[1] else member[2]
            out.append((doc_id, None if best[1] else best[2], len(members), member == best, digest))
    return sorted(out, key=key)


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
@pytest.mark.parametrize("guarantee", [2, 2048])
def test_exact_copies(request, table, guarantee):
    df = request.getfixturevalue(table)
    got = exact_dedup.exact_copies(df, guarantee=guarantee)
    assert sorted(map(tuple, got.collect()), key=key) == plain_copies(df.collect())


def test_frequent_texts_are_found_and_not_shuffled(spark):
    df = spark.range(3000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot  text' WHEN id % 3 = 1 THEN concat('t', id % 50) ELSE concat(id, '') END AS text"
    )
    rows = exact_dedup.digests(df)
    frequent = exact_dedup.frequent_texts(rows, counters=256, winners=64, guarantee=8).collect()
    assert [(row.group_size, row.keep.keep_id) for row in frequent] == [(1000, 0)]
    assert exact_dedup.without_copies(df).count() == 1 + 50 + 1000


def test_no_python_in_exact_copies(docs, capsys):
    exact_dedup.exact_copies(docs).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_rows_without_copies(request, table):
    df = request.getfixturevalue(table)
    kept = sorted((row[0] for row in plain_copies(df.collect()) if row[3]), key=lambda v: (v is not None, v))
    got = exact_dedup.without_copies(df)
    assert got.columns == df.columns
    assert sorted((row.doc_id for row in got.collect()), key=lambda v: (v is not None, v)) == kept


def plain_tree(nodes):
    """Root, and the witness (left, right) of each node."""
    paths, owners = [[] for _ in nodes], [[at] for at in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for place in range(len(run)):
                for leaf in owners[at + place]:
                    paths[leaf].append(("".join(run[:place]), "".join(run[place + 1 :])))
            above.append(sha("".join(run)))
            above_owners.append(sum(owners[at : at + 8], []))
        nodes, owners = above, above_owners
    return nodes[0], paths


def plain_manifest(rows, lower):
    def leaf(row, text):
        given = (row.doc_id, row.source, row.lang, row.n_chars, text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in given))

    groups = defaultdict(list)
    for row in rows:
        text = row.text
        if lower and row.doc_id is not None and text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        groups[row.lang].append((row.doc_id is not None, row.doc_id or 0, leaf(row, row.text), leaf(row, text)))
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: plain_tree([member[2] for member in sorted(groups[name])]) for name in names}
    if not names:
        return []
    root, tops = plain_tree([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops):
        for (named, doc_id, own, found), path in zip(sorted(groups[name]), trees[name][1]):
            for left, right in path + top:
                found = sha(left + found + right)
            proof = sha("".join(left + right for left, right in path + top))
            out.append((doc_id if named else None, own, trees[name][0], root, proof, found, found == root))
    return sorted(out, key=key)


def altered():
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(digest % 3 == 0, lower).otherwise(F.col("text"))}


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_manifest(request, table):
    df = request.getfixturevalue(table)
    got = merkle_manifest.verified_manifest(df, held=altered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=key) == plain_manifest(df.collect(), True)


def test_manifest_of_several_blocks(spark):
    """Blocks of 64 leaves: three heights of blocks, a last block of one leaf, many groups."""
    df = spark.range(64 * 70 + 1).selectExpr(
        "id AS doc_id", "concat('T', id) AS text", "CASE WHEN id < 4300 THEN 'a' ELSE concat('g', id % 70) END AS lang",
        "'s' AS source", "length(id) AS n_chars",
    )
    got = merkle_manifest.verified_manifest(df, height=2, held=altered())
    assert sorted(map(tuple, got.collect()), key=key) == plain_manifest(df.collect(), True)
    kept = merkle_manifest.witnesses(df, height=2).collect()
    for row in kept[::97]:
        path = list(zip(row.places, (others.encode() for others in row.siblings)))
        assert merkle_manifest.folded(row.leaf.encode(), path).decode() == row.root


def test_open_subtrees_extend_witnesses():
    """After any number of appends each witness holds what is complete, and later appends extend it."""
    subtrees = merkle_manifest.OpenSubtrees()
    for n in range(1, 201):
        subtrees.append(sha(str(n)).encode())
        for leaf, path in enumerate(subtrees.witnesses):
            done = 0
            while (leaf // 8 ** (done + 1) + 1) * 8 ** (done + 1) <= n:
                done += 1
            assert len(path) == done
