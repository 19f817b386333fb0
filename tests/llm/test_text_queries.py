"""Registered text queries against their SQL, and the pipeline against its stages' rules."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from check import compare

import corpus_pipeline
from chainlake.llm import queries
from conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, database, name):
    _, _, note = compare(spark, database, name, SF_DIR)
    assert note.startswith("ok") and "types" not in note, note


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_covers_the_whole_table(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert got.select("doc_id").distinct().count() == docs.count()


def test_pipeline(spark):
    from collections import Counter

    from test_operators import documents, expected_groups, expected_suffix

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        given = [(r.doc_id, r.text) for r in docs.collect()] if name != "quality_rules" else None
        docs = stage(spark, docs, SF_DIR)
        if name != "best_fit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        at[name] = (given, docs)
    given, kept = at["ngram_jaccard_join"]
    groups = expected_groups(given)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g[2] for g in groups})
    given, left = at["suffix_array_dedup"]
    want = {w[0]: w for w in expected_suffix(given, 200)}
    assert len(documents(given)) == left.count()
    for r in left.collect():
        if want[r.doc_id][2] == 0:
            assert r.text == dict(given)[r.doc_id]
        assert r.n_chars == len(r.text)
    _, masked = at["secret_scan"]
    assert not any("token = " in r.text and "<secret>" not in r.text for r in masked.collect())
    _, packed = at["best_fit_packing"]
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in masked.collect()}
    assert Counter(r.sequence_id for r in packed.collect())


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def five_word_sets(text):
    from test_operators import WORD

    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[p : p + 5]) for p in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def expected_near(given):
    """Of each group of near copies the row with the smallest id, equal rows once."""
    rows = sorted(set(given), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    sets = [five_word_sets(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [rows[g] for g in sorted(set(group))]


def near_stage(spark, given):
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in given], DOCS)
    return Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, df, "").collect())


def test_near_copies_by_five_words(spark):
    """Two changed words in 94 to 101 are a near copy by five-word shingles."""
    given = []
    for n in range(90, 106):
        words = [f"d{n}w{i}" for i in range(n)]
        given += [(2 * n, " ".join(words)), (2 * n + 1, " ".join("x" if i in (30, 60) else w for i, w in enumerate(words)))]
    assert near_stage(spark, given) == Counter(expected_near(given))
    assert (2 * 94 + 1, given[9][1]) not in near_stage(spark, given)


def test_near_copies_with_repeated_and_null_ids(spark):
    """An id with a copied and a clean text keeps the clean one; equal rows stay once."""
    texts = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(5)]
    near = texts[3].replace("t3w59", "end")
    given = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[2]), (None, texts[3]), (None, near), (4, None), (4, None), (5, "")]
    assert near_stage(spark, given) == Counter(expected_near(given))


def expected_quality(rows):
    """Ids kept by the rules: limits of language and source, of the language, and of all, mixed by counts."""
    from test_operators import WORD

    spreads = {"symbols": 100, "marks": 100, "repeats": 50, "lines": 30, "width": 100}
    rated = []
    for i, t, lang, source in rows:
        words = WORD.findall(t or "")
        n, per = len(words), max(len(words), 1)
        runs = Counter(tuple(words[p : p + 8]) for p in range(n - 7))
        again = len({q for p in range(n - 7) if runs[tuple(words[p : p + 8])] > 1 for q in range(p, p + 8)})
        lines = [line for line in (t or "").split("\n") if WORD.search(line)]
        values = {
            "symbols": sum((t or "").count(c) for c in "#*$%&|<>") * 1000 // per, "marks": sum((t or "").count(c) for c in "!?") * 1000 // per,
            "repeats": again * 1000 // per, "lines": (len(lines) - len(set(lines))) * 1000 // per, "width": sum(map(len, words)) * 100 // per,
        }
        rated.append((i, (lang, source), n >= 20 and 100 * again <= 30 * n, values))

    def fence(group):
        out = {}
        for name, least in spreads.items():
            cells = sorted((v >> b) << b for v in (r[3][name] for r in group) for b in [max(v.bit_length() - 5, 0)])
            low, high = cells[(len(cells) + 3) // 4 - 1], cells[(3 * len(cells) + 3) // 4 - 1]
            reach = 3 * max(high - low, least)
            out[name] = (low - reach if name == "width" else 0, high + reach)
        return out

    good = [r for r in rated if r[2]]
    everything = fence(good)
    kept = []
    for i, key, fine, values in rated:
        limits = everything
        for group in ([r for r in good if r[1][0] == key[0]], [r for r in good if r[1] == key]):
            if group:
                own, n = fence(group), float(len(group))
                limits = {m: tuple((n * o + 50.0 * w) / (n + 50.0) for o, w in zip(own[m], limits[m])) for m in own}
        if fine and all((limits[m][0] <= v or m != "width") and v <= limits[m][1] for m, v in values.items()):
            kept.append(i)
    return kept


def expected_masked(text):
    """The three patterns masked, and the planted random string."""
    hit = set()
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        hit |= set(range(*m.span())) if len(m[1]) >= 12 else set()
    for pattern in (r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}", BLOB):
        for m in re.finditer(pattern, text):
            hit |= set(range(*m.span()))
    return "".join("<secret>" if p in hit and p - 1 not in hit else "" if p in hit else c for p, c in enumerate(text))


BLOB = "qX7vR2mZ9kT4wLpB8sYnC3hJ"


def test_all_stages_against_brute_force(spark):
    """Rows, texts and packed pieces of every stage on a small table with planted cases."""
    import numpy as np
    from test_operators import removed_bytes
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = sorted((tuple(r) for r in docs.collect()), key=lambda r: r[0])[:120]
    lang, source = rows[0][2:4]
    fresh = [" ".join(f"k{k}{c}{d}" for c in "abcdefgh" for d in "rstuvwxyz") for k in range(6)]
    passage = " ".join(f"pass{c}" for c in "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz")
    planted = [
        fresh[0], fresh[0].replace("k0cr", "edit"), fresh[1] + " " + passage, passage + " " + fresh[2], fresh[3] + f" key {BLOB} end",
        fresh[4] + " token = abcdefghijklm AKIA" + "Z" * 16 + " 0123456789abcdef0", fresh[5] + " #$%&" * 60, "too short",
    ]
    rows += [(10**9 + k, t, lang, source, len(t)) for k, t in enumerate(planted)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        got = docs.collect()
        if name == "best_fit_packing":
            break
        if name == "quality_rules":
            ids = set(expected_quality([r[:4] for r in rows]))
            want = [r for r in rows if r[0] in ids]
        elif name == "ngram_jaccard_join":
            left = set(expected_near([r[:2] for r in rows]))
            want = [r for r in rows if r[:2] in left]
        elif name == "suffix_array_dedup":
            gone = removed_bytes([r[:2] for r in rows], 200)
            cut = [bytes(b for b, g in zip(r[1].encode(), hit) if not g).decode("utf-8", "ignore") for r, hit in zip(rows, gone)]
            want = [(r[0], t, *r[2:4], len(t)) for r, t in zip(rows, cut)]
        else:
            masked = [expected_masked(r[1]) for r in rows]
            want = [(r[0], t, *r[2:4], len(t)) for r, t in zip(rows, masked)]
        assert Counter(map(tuple, got)) == Counter(want), name
        assert [r[:2] for r in want] != [r[:2] for r in rows], name
        rows = want
        docs = spark.createDataFrame(rows, DOCS)
    coder = Tokenizer.from_file(queries.VOCABULARY)
    pieces = Counter()
    for i, t, *_ in rows:
        tokens = coder.encode(t, add_special_tokens=False).ids + [0]
        count, start = -(-len(tokens) // 2048), 0
        for piece in range(count):
            stop = len(tokens) - (count - 1 - piece) * 2048
            pieces[(i, piece, start, stop - start, zlib.crc32(np.array(tokens[start:stop], "<u4").tobytes()))] += 1
            start = stop
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    placed = {}
    for r in got:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_stages_with_very_long_texts(spark):
    """Texts of over a megabyte beside short ones, whole at the end: all but a near copy, and
    a passage of the long ones that comes again."""
    import random

    rnd = random.Random(8)
    pool = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(3, 9))) for _ in range(30_000)]
    long = " ".join(rnd.choices(pool, k=200_000))
    words = long.split()
    near = " ".join(["edit", *words[1:150_000], "edited", *words[150_001:]])
    passage = " ".join(words[1000:1100])
    given = [(1, long), (2, near), (3, passage + " " + " ".join(rnd.choices(pool, k=60)))] + [(10 + i, " ".join(rnd.choices(pool, k=80))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], DOCS)
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        left = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert set(left) == {i for i, _ in given} - ({2} if name != "quality_rules" else set())
    # A character beside the passage may be the same in both places by chance.
    assert len(passage) - 1 <= len(long) - len(left[1]) <= len(passage) + 5
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(left) and max(r.piece for r in packed) > 100
