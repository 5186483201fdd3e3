"""Each operator against a plain version on small tables, and on awkward rows."""

import hashlib
import pathlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
from compare import connect, difference
from postlane.llm import (
    chat_tree, decontaminate, packing, passages, quality_thresholds, simhash_covering, token_files, token_ids,
    toxicity, url_filter, warc,
)
from postlane.llm.components import components
from postlane.llm.oracles import ORACLES
from postlane.llm.token_ids import TextEncoder
from postlane.shared import scratch

SF_DIR = "/root/testdata/sf0.001"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
SPACES = r"[^\x20\x09-\x0D]+"
ODD_TEXTS = [
    None, "", " \n\t ", "one", "Ünï “quoted” don't 3.14 <|endoftext|> İstanbul ΑΣ", "a" * 30_000,
    "same words here. " * 400, "same words here. " * 400, "x y z é ​", "|#*$ <%&>",
]
DOCS = "doc_id long, text string, lang string, score double, kept string, fp long"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(at if at else None, text, None if at % 3 else "en", 1.0, "x", 5) for at, text in enumerate(ODD_TEXTS)]
    return spark.createDataFrame([*rows, rows[6]], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    assert difference(contract.queries()[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_word_cache_equals_the_tokenizer(docs):
    plain = Tokenizer.from_file(WORD_FILE)
    texts = [text or "" for text in ODD_TEXTS] + [row.text for row in docs.select("text").collect()]
    ids, starts = TextEncoder(WORD_FILE).encode([text.encode() for text in texts])
    for at, text in enumerate(texts):
        assert ids[starts[at] : starts[at + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("width", [1, 5, 17, 32])
def test_blocks_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1000).astype(np.uint32)
    ids[rng.integers(0, 1000, 30)] = 2**32 - 1
    data, start = token_files.encode_blocks(ids)
    assert (token_files.decode_blocks(data, start, len(ids)) == ids).all()


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_token_files(request, table):
    df, plain = request.getfixturevalue(table), Tokenizer.from_file(WORD_FILE)
    got = token_files.token_files(df, WORD_FILE, 2, ids_per_file=5000).collect()
    expected, start = Counter(), 0
    sizes = {}
    for row in df.collect():
        ids = np.array(plain.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        expected[(row.doc_id, len(ids), zlib.crc32(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    for row in sorted(got, key=lambda r: r.start):
        assert row.start == start
        assert sizes.get("last", -1) <= (row.doc_id if row.doc_id is not None else -1)
        start, sizes["last"] = start + row.n_tokens, row.doc_id if row.doc_id is not None else -1


def test_reading_some_documents_of_a_file(spark, tmp_path):
    path = f"{tmp_path}/some.pfr"
    ids = np.arange(1000, dtype=np.uint32)
    token_files.write_file(path, list(range(10)), [100] * 10, ids)
    assert [part.tolist() for part in token_files.read_documents(path, 3, 5)] == [
        list(range(300, 400)), list(range(400, 500))
    ]


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_packing(request, table):
    df, plain = request.getfixturevalue(table), Tokenizer.from_file(WORD_FILE)
    rows, capacity = packing.pack_documents(df, WORD_FILE, 1, 512).collect(), 512
    sequences, expected = defaultdict(list), Counter()
    for row in df.collect():
        ids = np.array(plain.encode(row.text or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[(row.doc_id, piece, at, len(part), zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.03 * -(-sum(r.length for r in rows) // capacity) + 1


def test_two_take_the_place_of_the_smallest():
    # Greedy: 6 + 2 leaves 2; instead of the 2, the two pieces of 2 and 2 fill the sequence.
    bins = packing.best_two_fit([6, 3, 2, 2], 10)
    filled = sorted(sorted([6, 3, 2, 2][place] for place in chosen) for chosen in bins)
    assert [2, 2, 6] in filled and sorted(sum(filled, [])) == [2, 2, 3, 6]


def plain_fingerprint(text):
    words = re.findall(SPACES, low(text))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("small", [64, 1])
@pytest.mark.parametrize("table", ["docs", "odd"])
def test_simhash(request, table, small):
    df = request.getfixturevalue(table)
    rows = [(row.doc_id, plain_fingerprint(row.text)) for row in df.collect()]
    prints = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            best = min(root[b] for b in prints if (a ^ b).bit_count() <= 2)
            if best < root[a]:
                root[a], changed = best, True
    least = {}
    for doc, fp in rows:
        if doc is not None:
            least[root[fp]] = min(doc, least.get(root[fp], doc))
    got = simhash_covering.near_duplicates(df, small=small).collect()
    assert Counter(map(tuple, got)) == Counter((doc, f"{fp:016x}", least.get(root[fp])) for doc, fp in rows)


def test_every_near_pair_collides_in_some_table():
    masks = simhash_covering.masks()
    for a in range(64):
        for b in range(a, 64):
            assert any(not mask & (1 << a | 1 << b) for mask in masks)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}


def plain_hits(text, items):
    split = lambda value: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(value))
    words, hit, found = split(text), set(), set()
    for item, value in items:
        own = split(value)
        for i in range(max(1, len(own) - 9) if own else 0):
            window = own[i : i + 10]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(str(item))
    named = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), named, bool(hit)


@pytest.mark.parametrize("most", [1, 10, 11, 25, 100])
def test_runs_of_words_hold_each_window_once(most):
    for size in (0, 1, 9, 10, 11, 40):
        words = [b"%d" % at for at in range(size)]
        runs = list(decontaminate.runs_of_words(words, most))
        windows = [tuple(run[at : at + 10]) for run in runs for at in range(max(1, len(run) - 9))]
        assert windows == [tuple(words[at : at + 10]) for at in range(max(1, size - 9))]
        assert all(len(run) <= max(most, 10) for run in runs)


def test_test_windows_are_written_by_tasks_in_bounded_blocks(spark):
    items = spark.createDataFrame(
        [(at, " ".join(f"w{at}x{n}" for n in range(40))) for at in range(30)], "item_id long, text string"
    )
    paths = decontaminate.write_blocks(items, "item_id", "text", 100)
    blocks = [decontaminate.load_block(path) for path in paths]
    assert len(blocks) >= 12 and max(len(block.terms) for block in blocks) <= 100
    assert sum(len(block.windows) for block in blocks) == 30 * 31


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 3])
def test_decontamination_of_odd_rows(spark, odd, block_words):
    items = [(1, "words here same"), (2, None), (3, "!!"), (10, "one"), (4, "same words here " * 5), (4, "z")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(odd, table, block_words=block_words).drop("n_near_items").collect()
    expected = Counter((row.doc_id, *plain_hits(row.text, items)) for row in odd.collect())
    assert Counter(map(tuple, got)) == expected


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x green y blue"), (2, "red " + "x " * 50 + "green blue")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "green blue red")], "item_id long, text string")
    got = {row.doc_id: (row.n_hit, row.n_near_items) for row in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (0, 1), 2: (0, 0)}


def test_quality_counts(spark, docs, odd):
    for df in (docs, odd):
        columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        got = Counter((r.doc_id, *(r[c] for c in columns)) for r in quality_thresholds.measure(df).collect())
        expected = Counter()
        for row in df.collect():
            text = row.text or ""
            words = re.findall(SPACES, text)
            n = len(words)
            lines = [line for line in text.split("\n") if re.search(SPACES, line)]
            seen = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
            hit = {p for i in range(n - 7) if seen[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
            expected[(
                row.doc_id, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n,
            )] += 1
        assert got == expected


def test_cutoffs_hold_the_risk(spark):
    words = [f"w{i}" for i in range(40)]
    rows, labels = [], []
    for at in range(3000):
        bad = at % 5 == 0
        text = " ".join(word + ("###" if bad else "") for word in words)
        rows.append((at, text, "en"))
        labels.append((at, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {row.doc_id: row.kept for row in quality_thresholds.quality(docs, known).collect()}
    assert all(kept == (doc % 5 != 0) for doc, kept in got.items())
    few = known.where("doc_id < 60")
    assert all(row.kept for row in quality_thresholds.quality(docs, few).collect())


def test_binomial_bound():
    from math import comb

    for k, n, p in [(0, 10, 0.1), (3, 50, 0.06), (50, 50, 0.2), (7, 300, 0.015)]:
        plain = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_thresholds.binomial_cdf(k, n, p) == pytest.approx(plain)


def test_toxicity_does_not_depend_on_batches(spark):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aeiounrstlh"), rng.integers(3, 9))) for _ in range(300)]
    rows = [(at, " ".join(rng.choice(plain, 12)) + (" you grobnik" if at % 3 else "")) for at in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(at, int(at % 3 > 0)) for at in range(300)], "doc_id long, toxic int")
    scores = [
        {row.doc_id: row.score for row in toxicity.toxicity(docs.repartition(parts), known).collect()}
        for parts in (1, 7)
    ]
    assert scores[0] == scores[1]
    weights = rng.normal(size=toxicity.LETTERS**3)
    alone = [float(toxicity.unit_values([word], weights)[0]) for word in plain]
    assert toxicity.unit_values(plain, weights).tolist() == alone


def plain_value(unit, weights):
    """The best run of a string: its gapped triples, added up one by one."""
    text, best = f"^{unit}$", toxicity.LOWEST
    code = [
        40 if c == "^" else 41 if c == "$" else ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 13 for c in text
    ]
    for run in range(len(text) - toxicity.STARTS + 1):
        value = norm = 0.0
        for first in range(run, run + toxicity.STARTS):
            for second in range(first + 1, first + toxicity.SPAN - 1):
                for third in range(second + 1, min(first + toxicity.SPAN, len(text))):
                    factor = toxicity.GAP_COST ** (third - first - 2)
                    triple = (code[first] * toxicity.LETTERS + code[second]) * toxicity.LETTERS + code[third]
                    value, norm = value + factor * weights[triple], norm + factor**2
        if norm > 1e-6:
            best = max(best, value / norm**0.5)
    return best


def test_toxicity_kernel_against_plain_triples():
    rng = np.random.default_rng(11)
    weights = rng.normal(size=toxicity.LETTERS**3)
    units = ["".join(rng.choice(list("abcdeßé語"), size)) for size in rng.integers(3, 30, 60)]
    got = toxicity.unit_values(units, weights)
    assert np.allclose(got, [plain_value(unit, weights) for unit in units])


def test_training_takes_little_of_the_driver():
    """No table of all triples and landmarks in double precision, and no features in more copies than the machine needs."""
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 12)))
    positives, negatives = [word() for _ in range(300)], [word() for _ in range(2200)]
    tracemalloc.start()
    toxicity.train_weights(positives, rng.random(300) * 50, negatives)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 236e6


def test_training_holds_features_once_and_rows_of_landmarks_only():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 12)))
    positives, negatives = [word() for _ in range(300)], [word() for _ in range(2200)]
    runs = sum(max(1, len(unit) - 1) for unit in negatives) + 2 * len(positives)
    tracemalloc.start()
    toxicity.train_weights(positives, rng.random(300) * 50, negatives)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3.7 * runs * 8 * (toxicity.LANDMARKS + 1)


def test_features_do_not_depend_on_what_is_held_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    units = ["".join(rng.choice(list("abcdefgh"), 9)) for _ in range(40)]
    triples, weights, _ = toxicity._run_vectors(units)
    used, row = toxicity._rows_of(triples[:30])
    assert (row[used] == np.arange(len(used))).all() and (np.delete(row, used) == len(used)).all()
    dense = rng.normal(size=(len(used) + 1, 30)).astype(np.float32)
    dense[-1] = 0
    project = rng.normal(size=(30, 20))
    whole = np.zeros((toxicity.LETTERS**3, 30), np.float32)
    whole[used] = dense[:-1]
    plain = toxicity._kernel_to(triples, weights, whole) @ project
    for held in (16, len(triples), 2 * len(triples)):
        monkeypatch.setattr(toxicity, "RUNS_AT_ONCE", held)
        got = toxicity._features(row[triples], weights, dense, project)
        assert np.allclose(got[:, :-1], plain, rtol=0, atol=1e-12) and (got[:, -1] == 1).all()


def test_the_driver_does_not_train(spark, monkeypatch):
    class Called(Exception):
        pass

    def here(*given):
        raise Called

    positives, negatives = ["idiot", "moron", "idiots"], ["harbour", "window", "meadow", "garden"]
    importance = np.array([3.0, 2.0, 1.0])
    expected = toxicity.train_weights(positives, importance, negatives)
    got = toxicity.trained_weights(spark, positives, importance, negatives)
    assert np.allclose(got, expected, rtol=0, atol=1e-9)
    docs = spark.createDataFrame(
        [(at, f"you are an idiot {at}" if at % 3 == 0 else f"the harbour lies calm {at}") for at in range(300)],
        "doc_id long, text string",
    )
    known = spark.createDataFrame([(at, int(at % 3 == 0)) for at in range(300)], "doc_id long, toxic int")
    trained = []

    def instead(session, *given):
        trained.append(given)
        return expected

    monkeypatch.setattr(toxicity, "train_weights", here)
    monkeypatch.setattr(toxicity, "trained_weights", instead)
    assert toxicity.train(docs, known).weights is not None and len(trained) == 3


def test_kernel_to_landmarks_against_plain_products():
    units = ["idiot", "idxiot", "harbour", "abcabcab"]
    triples, weights, home = toxicity._run_vectors(units)
    dense = np.zeros((toxicity.LETTERS**3, len(triples)), np.float32)
    for mark in range(len(triples)):
        np.add.at(dense[:, mark], triples[mark], weights[mark])
    vectors = []
    for run in range(len(triples)):
        vector = {}
        for triple, weight in zip(triples[run].tolist(), weights[run].tolist()):
            vector[triple] = vector.get(triple, 0.0) + weight
        vectors.append(vector)
    plain = [[sum(w * b.get(t, 0.0) for t, w in a.items()) for b in vectors] for a in vectors]
    assert np.allclose(toxicity._kernel_to(triples, weights, dense), plain, atol=1e-5)
    near = [max(plain[a][b] for a in np.flatnonzero(home == 0) for b in np.flatnonzero(home == at)) for at in (1, 2)]
    assert near[0] > 0.5 > near[1]


def test_very_long_words_take_bounded_memory():
    weights = np.zeros(toxicity.LETTERS**3)
    weights[(9 * toxicity.LETTERS + 4) * toxicity.LETTERS + 9] = 1.0  # i, d, i
    word = "q" * 4_000_000 + "idiot"
    plain = toxicity.text_values(pa.array(["zz qqqq idiot"]), weights)
    tracemalloc.start()
    got = toxicity.text_values(pa.array([word, "q q q", " ".join("q" * 3000), None]), weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] > 0 and plain[0] > 0 and got[1] == got[2] == 0 and got[3] == toxicity.LOWEST
    assert peak < 200e6
    for size in (0, 5, 1000, 1001, 1950, 1951, 5000):
        unit = "".join(chr(97 + at % 26) for at in range(size))
        pieces = toxicity.pieces_of(unit)
        assert pieces[0] + "".join(piece[toxicity.OVERLAP :] for piece in pieces[1:]) == unit
        assert max(map(len, pieces)) <= toxicity.LONGEST


def test_toxicity_learns_and_bears_gaps(spark):
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("aeiounrstlh"), rng.integers(3, 9))) for _ in range(400)]
    rows, labels = [], []
    for at in range(900):
        words = list(rng.choice(plain, 30))
        if at % 6 == 0:
            words[7] = ["dumbwit", "z.u.p.f.k.o.p", "zupfkop", "d u m b w i t"][at // 6 % 4]
        rows.append((at, " ".join(words)))
        labels.append((at, int(at % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    held = [row for row in got if row.held_out]
    assert held and all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in got)
    assert sum(row.predicted == (row.doc_id % 6 == 0) for row in held) >= 0.95 * len(held)


def test_scores_of_odd_rows(spark, odd):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert [row.score for row in toxicity.toxicity(odd, nothing).collect()] == [0.0] * odd.count()
    values = toxicity.unit_values(["", "ab", "word", "日本語"], np.ones(toxicity.LETTERS**3))
    assert values[0] == values[1] == toxicity.LOWEST and values[2] > 0


def test_passages(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    passage = [word() for _ in range(70)]
    edited = list(passage)
    for at in (15, 31, 47, 60):
        edited[at] = word()
    fresh = lambda n: [word() for _ in range(n)]
    texts = [
        fresh(30) + passage + fresh(20), fresh(200), fresh(5) + edited + fresh(60), passage,
        fresh(40) + passage[:30], None, "", "lo " * 300, "lo " * 300,
    ]
    rows = [(at, " ".join(text) if isinstance(text, list) else text) for at, text in enumerate(texts)]
    rows += [(None, " ".join(passage)), rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.source_doc_id, r.start_word, r.end_word) for r in passages.repeated_passages(docs).collect()}
    assert got == {(2, 0, 5, 75), (3, 0, 0, 70)}
    left = {row.doc_id: row.text for row in passages.without_repeats(docs).where("doc_id is not null").collect()}
    assert set(left) == {0, 1, 2, 4, 5, 6, 7, 8} and left[0] == rows[0][1]
    assert left[2].split() == texts[2][:5] + texts[2][75:]


def spans(docs):
    return {tuple(r)[:6] for r in passages.repeated_passages(docs).collect()}


def test_unlike_gaps_split_chains(spark):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    whole, head, foot = own("w", 120), own("h", 55), own("f", 55)
    texts = [whole, whole[:60] + own("x", 45) + whole[60:], head + own("y", 40) + foot, head + own("z", 40) + foot]
    sparse = own("s", 55) + [f"s{55 + i}" if i % 14 < 6 else f"u{i}" for i in range(104)]
    texts += [own("s", 159), sparse]
    table = spark.createDataFrame([(i, " ".join(text)) for i, text in enumerate(texts)], "doc_id long, text string")
    found = spans(table)
    assert {row for row in found if row[0] < 5} == {
        (1, 0, 60, 0, 0, 60), (1, 105, 165, 0, 60, 120), (3, 0, 55, 2, 0, 55), (3, 95, 150, 2, 95, 150),
    }
    assert any(row[0] == 5 and row[1] == 0 and 55 <= row[2] <= 75 for row in found)


def test_passages_of_stock_lines(spark):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    lines = [own(f"line{k}x", 10) for k in range(6)]
    texts = {}
    for k, often in enumerate((1, 3, 10, 40, 2, 20)):
        for i in range(often):
            texts[1000 * k + i] = own(f"p{k}x{i}x", 20) + lines[k] + own(f"q{k}x{i}x", 20)
    same = sum(lines, [])
    texts[10_000], texts[10_001] = own("a", 30) + same + own("b", 30), own("c", 40) + same + own("d", 40)
    table = spark.createDataFrame([(i, " ".join(text)) for i, text in texts.items()], "doc_id long, text string")
    assert spans(table) == {(10_001, 40, 100, 10_000, 30, 90)}


def test_rounds_go_on_without_a_passage(spark):
    words = [f"w{i}" for i in range(80)]
    piece = lambda a: words[a : a + 20]
    gap = lambda name: [f"{name}{i}" for i in range(70)]
    # Bits of the passage in two orders take its longer keys too, so only a later round can find it.
    first = sum((words[a : a + 31] + gap(f"g{a}x") for a in (49, 35, 21, 7, 0, 14, 28, 42)), [])
    shuffled = piece(60) + piece(20) + piece(0) + piece(40)
    rows = [(1, first), (2, shuffled), (3, words), (4, gap("z") + words)]
    table = spark.createDataFrame([(i, " ".join(text)) for i, text in rows], "doc_id long, text string")
    assert (4, 70, 150, 3, 0, 80) in spans(table)


def test_passages_behind_many_documents_that_hold_most_of_them(spark):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    texts = {}
    for p in range(3):
        whole = own(f"whole{p}x", 52)
        for i in range(40):  # each too short for a passage, and before the documents that hold all of it
            texts[100 * p + i] = own(f"a{p}x{i}x", 20) + (whole[:46], whole[6:])[i % 2] + own(f"b{p}x{i}x", 20)
        for i in range(6):
            texts[1000 + 10 * p + i] = own(f"c{p}x{i}x", 10 + i) + whole + own(f"d{p}x{i}x", 20)
    table = spark.createDataFrame([(i, " ".join(text)) for i, text in texts.items()], "doc_id long, text string")
    found = spans(table)
    held = {1000 + 10 * p + i: (10 + i, 62 + i) for p in range(3) for i in range(6)}
    assert {row[0] for row in found} == {doc for doc in held if doc % 10}
    assert all(row[1:3] == held[row[0]] and row[4:] == held[row[3]] and row[3] < row[0] for row in found)


def test_documents_meet_that_a_chain_may_join(spark):
    """All that have a chain, by comparing every two, and none that share two seeds which no chain joins."""
    rng = np.random.default_rng(8)
    least = 22
    held = {}
    for doc in range(60):
        pos = np.unique(rng.integers(0, 200, rng.integers(4, 24)))
        held[doc] = (pos, rng.integers(0, 30, len(pos)))
    held[100] = held[101] = (np.array([0, 40]), np.array([100, 101]))  # as far apart as a passage needs, but too far to chain
    held[102] = held[103] = (np.array([0, 29]), np.array([102, 103]))  # just paid for
    rows = [(int(h), doc, int(at)) for doc, (pos, hashes) in held.items() for at, h in zip(pos, hashes)]
    seeds = spark.createDataFrame(rows, "h long, doc_id long, pos int")
    met = {tuple(row) for row in passages.later_and_earlier(seeds, seeds, least).collect()}
    chained = set()
    for doc, (pos, hashes) in held.items():
        for rep in (rep for rep in held if rep < doc):
            other, keys = held[rep]
            first = {h: other[keys == h][0] for h in hashes.tolist() if (keys == h).any()}
            some = [at for at, h in enumerate(hashes.tolist()) if h in first]
            if some:
                begin, to, length = passages.merge_runs(pos[some], np.array([first[hashes[at]] for at in some]))
                chains = passages.chain_runs(begin, to, length)
                if any(begin[one[-1]] + length[one[-1]] - begin[one[0]] >= least for one in chains):
                    chained.add((doc, rep))
    assert len(chained) > 50 and chained <= met
    assert (103, 102) in chained and (101, 100) not in met


def test_documents_too_short_for_a_passage_meet_none(spark, monkeypatch):
    own = lambda name, n: [f"{name}{i}" for i in range(n)]
    met, plain = [], passages.later_and_earlier

    def counted(*tables):
        found = plain(*tables)
        met.append(found.count())
        return found

    monkeypatch.setattr(passages, "later_and_earlier", counted)
    texts = {i: own("w", 48) for i in range(20)}
    texts[30], texts[31] = own("a", 9) + own("w", 48) + own("b", 9), own("c", 9) + own("w", 48) + own("b", 9)
    table = spark.createDataFrame([(i, " ".join(text)) for i, text in texts.items()], "doc_id long, text string")
    assert spans(table) == {(31, 9, 66, 30, 9, 66)}
    assert met == [0]  # the two are found in a round before
    short = passages.short_documents(spark.createDataFrame(
        [(1, "a b"), (2, " a\tb\nc "), (3, None), (4, ""), (5, "a b c d"), (6, "abc de"), (7, "é\u00a0b c")], "doc_id long, text string"), 3)
    assert {row.doc_id for row in short.collect()} == {1, 3, 4, 6, 7}


def test_two_seeds_far_apart_are_one_key(spark):
    seeds = spark.createDataFrame([(h, 1, pos) for h, pos in ((7, 0), (8, 20), (9, 40), (10, 45))], "h long, doc_id long, pos int")
    found = passages.chain_starts(seeds, 30, 17, 82, 16).collect()
    # 0 and 20, 20 and 40, 20 and 45; from 40 no seed is far enough.
    assert sorted(row.apart for row in found) == [20, 20, 25]
    assert len(passages.chain_starts(seeds, 30, 17, 82, 30).collect()) > len(found)


def test_words_beside_a_run_tell_how_far_it_reaches():
    rng = np.random.default_rng(4)
    told = 0
    for _ in range(400):
        x, y = (rng.integers(0, rng.choice([2, 3, 20]), rng.integers(30, 90)).astype("<u4") for _ in range(2))
        length = int(rng.integers(5, 25))
        at, other = int(rng.integers(0, len(x) - length)), int(rng.integers(0, len(y) - length))
        y[other : other + length] = x[at : at + length]
        beside = passages.BESIDE
        got = passages.reach(
            length, x[max(0, at - beside) : at], y[max(0, other - beside) : other],
            x[at + length :][:beside], y[other + length :][:beside],
        )
        start, end = passages.align_chain(x, y, [at], [other], [length])[:2]
        assert got is None or got == end - start
        told += got is not None
    assert told > 200


def test_texts_are_not_shuffled_for_their_words(spark):
    texts = spark.range(200).selectExpr("id AS doc_id", "repeat('word ', 40) AS text")
    named = spark.range(0, 400, 20).selectExpr("id AS doc_id")
    some = passages.likely_named(texts, named.union(named))
    found = [row.doc_id for row in some.collect()]
    assert set(found) >= set(range(0, 200, 20)) and len(found) == len(set(found)) < 20
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "Aggregate" not in passages.word_hashes(some)._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]


def test_chains_follow_both_orders():
    chains = passages.chain_runs(np.array([0, 20, 40, 10]), np.array([0, 22, 43, 500]), np.array([10, 10, 10, 10]))
    assert [0, 1, 2] in chains and [3] in chains


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "HTTP://A.Example.ORG/es/x?q#f"), (2, None), (3, "nothing"), (4, "http://b.net/p/?utm_a=1&b=2&a=1#z"),
         (5, "https://www.b.net:443/p?a=1&b=2"), (6, "http://c.net/"), (None, "http://x.com/de/1"), (8, "http://com/fr/"),
         (9, "http://xcom/de/"), (6, "http://c.net/")],
        "page_id long, url string",
    ).selectExpr("*", "'x' AS host", "1 AS hit")
    listed = spark.createDataFrame([("http://b.net/p?b=2&a=1",), (None,)], "url string")
    rules = contract.TEXT_QUERIES and __import__("postlane.llm.queries", fromlist=["x"]).URL_RULES
    for blocks in (1, 100):
        got = Counter(tuple(row) for row in url_filter.judge_urls(pages, listed, rules, max_blocks=blocks).collect())
        assert got == Counter([
            (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "b.net", "/p/", None, "block"), (5, "www.b.net:443", "/p", None, "block"),
            (6, "c.net", "/", None, "allow"), (6, "c.net", "/", None, "allow"),
            (None, "x.com", "/de/1", "com/de/", "block"), (8, "com", "/fr/", "com/fr/", "allow"),
            (9, "xcom", "/de/", None, "allow"),
        ])
    empty = spark.createDataFrame([], "url string")
    assert url_filter.judge_urls(pages, empty).where("verdict = 'block'").isEmpty()


def test_warc(spark):
    big, huge = "b" * 1500, "é<" * 30_000
    rows = [(1, "http://a/ä?x=%20\n", big), (2, None, big), (3, "u", huge), (4, "u", None), (5, "v", ""), (None, "w", big),
            (6, "s", "short"), (7, "s", "short"), (3, "u", huge)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest")
    got = Counter(tuple(r) for r in warc.archive(pages, file_bytes=3000).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    expected = Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        old = len(raw) >= 1000 and html == big and page != 2
        expected[(page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if old else "response", 2 if old else None)] += 1
    assert got == expected


def test_segments_that_do_not_fit_are_errors():
    assert warc.unframed(b"5;x=1\r\nhello\r\n0\r\nT: 1\r\n\r\n") == b"hello"
    with pytest.raises(ValueError):
        warc.unframed(b"5\r\nhel")


def test_chat_text_is_reversible():
    for text in ("<|im_end|>", "<\\|im_start|>", "<\\\\|", "plain", "", "<|<|\n|>"):
        assert chat_tree.unescape(chat_tree.escape(text)) == text and "<|" not in chat_tree.escape(text)
        assert chat_tree.unescape_role(chat_tree.escape_role(text)) == text


def test_chats_share_their_first_turns(spark):
    rows = []
    for conv in range(30):
        rows += [(conv, 0, "user", "hello"), (conv, 1, "assistant", f"reply {conv % 3}")]
    rows += [(None, 0, None, None), (99, None, "user", "first"), (99, 1, "assistant", "<|im_end|>")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'p' AS path")
    members, different = chat_tree.paths(table, "conv_id", "turn", "role", "text")
    blocks = chat_tree.build_blocks(different.coalesce(1), BYTE_FILE).collect()
    nodes = [node for block in blocks for node in block.nodes]
    assert sum(node.parent < 0 for node in nodes) <= 2 + len(blocks) and len(nodes) <= 7 + len(blocks)
    for block_tokens in (1, 65_536):
        got = {r.conv_id: r for r in chat_tree.format_chats(table, BYTE_FILE, block_tokens=block_tokens).collect()}
        assert len(got) == 32 and got[None].n_turns == 1
        assert got[4].turns_sha256 == hashlib.sha256(b"user\nhello\nassistant\nreply 1\n").hexdigest()
        assert got[99].loss_chars == 10 and got[99].loss_sha256 == hashlib.sha256(b"<|im_end|>").hexdigest()


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for found in (
        quality_thresholds.quality(none, labels), toxicity.toxicity(none, labels),
        token_files.token_files(none, WORD_FILE, 2), decontaminate.contamination(none, items),
        passages.repeated_passages(none), passages.without_repeats(none),
        url_filter.judge_urls(pages, pages.select("url")), simhash_covering.near_duplicates(none),
        simhash_covering.one_of_each(none), packing.pack_documents(none, WORD_FILE, 1),
        chat_tree.format_chats(chats, BYTE_FILE), warc.archive(pages),
    ):
        assert found.isEmpty()


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0.5 * docs.count()


def test_rows_that_share_an_id(spark):
    """Ids 1, 2, 2, 2: spans belong to one text, the others stay as they are; unlike texts are no copies."""
    rng = np.random.default_rng(5)
    words = [f"w{n}" for n in rng.integers(0, 10**6, 400)]
    shared, own, other = " ".join(words[:80]), " ".join(words[80:200]), "quite short"
    rows = [(1, shared), (2, own + " " + shared), (2, other), (2, other), (3, other), (None, shared), (None, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = Counter((r.doc_id, r.text) for r in passages.without_repeats(df).collect())
    compared = min((own + " " + shared, other), key=lambda text: spark.sql("SELECT xxhash64(:t)", {"t": text}).first()[0])
    expected = Counter(rows)
    if compared != other:
        expected[(2, own + " " + shared)] = 0
        expected[(2, own)] = 1
    assert left == +expected
    kept = Counter((r.doc_id, r.text) for r in simhash_covering.one_of_each(df).collect())
    assert kept == Counter([(1, shared), (2, own + " " + shared), (2, other), (None, shared), (None, shared)])


def test_a_row_that_is_most_of_the_table(spark):
    rows = spark.range(600).selectExpr("IF(id < 500, 7, id) AS doc_id", "IF(id < 500, 'one two three four', concat('t', id)) AS text")
    assert simhash_covering.one_of_each(rows).where("doc_id = 7").count() == 1
    assert passages.without_repeats(rows).count() == 600


def test_rounds_leave_no_tables(spark):
    texts = spark.range(60).selectExpr(
        "id AS doc_id", "array_join(transform(sequence(1, 90), i -> concat('w', (i * 7919) % 1000 + (id % 3) * 5000)), ' ') AS text"
    )
    with scratch(clear=False) as mine:
        found = passages.repeated_passages(texts).count()
    assert found == 57
    left = [path for _, path in mine.paths if pathlib.Path(path).exists()]
    assert left and all(pathlib.Path(path).name.startswith("passages-") for path in left)


def test_the_word_table_keeps_frequent_words(docs):
    encoder = TextEncoder(WORD_FILE)
    encoder.known.limit = 300
    texts = [(row.text or "").encode() for row in docs.select("text").collect()] + [b"x" * 70_000, b"", b"a b" * 50]
    plain = TextEncoder(WORD_FILE)
    for at in range(0, len(texts), 5):
        ids, starts = encoder.encode(texts[at : at + 5])
        whole, edges = plain.encode(texts[at : at + 5])
        assert (ids == whole).all() and (starts == edges).all()
    assert len(encoder.known) < len(plain.known)


def test_word_hashes_tell_terms_apart():
    terms = ["", "a", "aa", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "b", "é", "e" + chr(0), "e"] + [str(n) for n in range(5000)]
    for offset in (0, 3):
        array = pa.array(["skip"] * offset + terms, pa.large_string())[offset:]
        first, second, lengths = token_ids.term_hashes(array)
        assert len(set(first.tolist())) == len(set(second.tolist())) == len(set(terms))
        assert lengths.tolist() == [len(term.encode()) for term in terms]


def test_texts_are_cut_once(spark):
    """The filter on cut texts does not bring a second Python worker into the stage."""
    same = " ".join(f"w{at}" for at in range(80))
    df = spark.createDataFrame([(at, f"own{at} {same}") for at in range(4)], "doc_id long, text string")
    left = passages.without_repeats(df)
    plan = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(row.text for row in left.collect())[1:] == ["own1", "own2", "own3"]
