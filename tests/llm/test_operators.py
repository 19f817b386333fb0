"""The text operators against brute force, on small tables that hold the awkward cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chainlake.llm import (
    anchors, bpe, components, extend, grades, lattice, ngram_join, packing, periods, pieces, quality_rules, queries, ranking, secret_scan,
    suffix, urls,
)
from chainlake.llm.base import ready

# Extra columns that have the names of columns the operators make themselves.
CLASHES = ["digest", "rid", "n", "key", "component", "kept", "start", "length", "spans", "_utf8", "ids", "runs", "host"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


def vocabulary(rnd, n=40):
    return ["".join(rnd.choices("abcdeéñß日", k=rnd.randint(1, 6))) for _ in range(n)]


def corpus(seed=1):
    """Texts with copies, near copies, shared passages, repeats inside a text, and rows
    without text or id; one row comes twice."""
    rnd = random.Random(seed)
    words = vocabulary(rnd, 300)

    def prose(n):
        return "".join(w + rnd.choice([" ", " ", " ", "\n", "  ", "\t"]) for w in rnd.choices(words, k=n))

    passage, other = prose(70), prose(45)
    texts = [prose(rnd.randint(1, 160)) for _ in range(14)]
    texts += [prose(30) + passage + prose(20) for _ in range(4)] + [passage + other, other + prose(10) + other]
    base = prose(120)
    parts = base.split(" ")
    for i in range(5):
        changed = list(parts)
        changed[10 + i] = f"edit{i}"
        texts.append(" ".join(changed))
    texts += [texts[2], texts[2], base, "ab " * 150, "xy" * 400, "Ab aB AB " * 30, "", " \n ", None, None, "one", "one two", "ONE two"]
    texts.append(prose(6000))
    rows = [(i if i % 11 else 1000 + i, t) for i, t in enumerate(texts)]
    rows += [rows[3], (None, prose(50)), (None, rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows, parts=3):
    full = [(i, t, "en", "s1", None, *["x"] * len(CLASHES)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def documents(rows):
    """Rows that repeat an id and a text are one document."""
    return list(dict.fromkeys(rows))


def ids(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    made = [
        secret_scan.scan(none, queries.RANKS, queries.PATTERN), packing.packed(none, queries.VOCABULARY, queries.PATTERN),
        quality_rules.verdicts(none), suffix.without_repeats(none), extend.without_later_repeats(none),
        ngram_join.similar(none), bpe.round_trip(none, queries.MULTI_RANKS, queries.PATTERN), urls.judge(pages, rules),
        lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        grades.graded(none, grades.train(none, spark.createDataFrame([], "doc_id long, g int"), F.col("g"), 2)),
    ]
    assert [df.count() for df in made] == [0] * len(made)


# Secret scan


def test_secret_scan(spark, rows):
    rnd = random.Random(3)
    blob = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
    texts = [
        'Password: "abcdefghijkl"', "token=short token = " + "q" * 12, "password=token=abcdefghijklmnop", "apiKey:'x" + "1" * 11 + "'",
        "AKIA" + "Z" * 14, "AKIA" + "Z" * 13, "é " + "0123456789abcdef" + " 0123456789abcde", "key " + blob + " end",
        hashlib.sha1(b"x").hexdigest(), "123e4567-e89b-12d3-a456-426614174000", "ſecret=abcdefghijklmno", None, "",
    ]
    given = rows + list(enumerate(texts, 5000))
    got = collections.Counter(map(tuple, secret_scan.scan(frame(spark, given), queries.RANKS, queries.PATTERN).collect()))
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = collections.Counter()
    for i, t in given:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        want[(i, *[sum(k == kind for _, kind, _ in found) for k in range(3)], hashlib.sha256(text.encode()).hexdigest(), text)] += 1
    assert collections.Counter((*r[:4], r[5], ",".join(s for s in r[6].split(",") if not s.startswith("dense"))) for r in got.elements()) == want
    spans = {r[0]: r[6] for r in got}
    assert spans[5007] == "dense:4:44"
    assert not any("dense" in spans[i] for i in (5008, 5009, 5011, 5012))


def test_redact(spark):
    df = spark.createDataFrame([(1, "a token = abcdefghijkl b"), (2, None), (3, "clean")], "doc_id long, text string")
    got = dict(map(tuple, secret_scan.redact(df, queries.RANKS, queries.PATTERN).collect()))
    assert got == {1: "a <secret> b", 2: None, 3: "clean"}


def test_random_strings_within_runs():
    """Random strings are found without digits and behind plain words; plain runs are not."""
    coder = secret_scan.vocabulary(queries.RANKS, queries.PATTERN)
    rnd = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    before = ["", "session_identifier_value=", "services/hooks/incoming/", "export/customer/account/history/", "refresh-authorization-header-value-"]
    for prefix in before:
        for signs in (letters, letters + "0123456789"):
            found = 0
            for _ in range(100):
                text = "see " + prefix + "".join(rnd.choices(signs, k=32)) + " end"
                start = 4 + len(prefix)
                hit = {p for a, _, b in secret_scan.dense_spans(text, coder) for p in range(a, b)}
                found += len(hit & set(range(start, start + 32))) >= 24
            assert found >= 97
    plain = [
        "INTERNATIONALIZATION_SETTINGS_DEFAULT", "getHTTPResponseStatusCodeFromRequestHandler", "backup-2024-01-15-03-22-11-data",
        "blob/commit/da39a3ee5e6b4b0d3255bfef95601890afd80709/file", "orders/123e4567-e89b-12d3-a456-426614174000/items/list",
        "Donaudampfschifffahrtsgesellschaft", "uudenvuodenaattohuippulehtolammas", "a/b/c/path/to/some/file/in/the/tree", "ACGT" * 10,
        "nguyen-thi-minh-khai-phuong-xa", "Nguyen-Thi-Minh-Khai-Phuong-Xa",
    ]
    assert [t for t in plain if secret_scan.dense_spans(t, coder)] == []


# Packing


def test_packing(spark, rows):
    got = packing.packed(frame(spark, rows), queries.VOCABULARY, queries.PATTERN).collect()
    coder = Tokenizer.from_file(queries.VOCABULARY)
    want = collections.Counter()
    for i, t in rows:
        tokens = coder.encode(t or "", add_special_tokens=False).ids + [0]
        count = -(-len(tokens) // 2048)
        start = 0
        for piece in range(count):
            stop = len(tokens) - (count - 1 - piece) * 2048
            want[(i, piece, start, stop - start, zlib.crc32(np.array(tokens[start:stop], "<u4").tobytes()))] += 1
            start = stop
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    placed = collections.defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(placed) <= -(-sum(r.length for r in got) // 2048) + 1


def test_sum_of_squares_choice():
    rnd = np.random.default_rng(1)
    sizes = rnd.integers(1, 40, 300)
    where, offset, gaps = packing.pack(sizes, 40)
    # The rule itself, by trying every choice.
    open_gaps: list[int] = []
    for size, sequence in zip(sizes.tolist(), where.tolist()):
        def total(after):
            count = collections.Counter(g for g in after if 0 < g < 40)
            return sum(v * v for v in count.values())

        choices = [total([*open_gaps[:i], g - size, *open_gaps[i + 1 :]]) for i, g in enumerate(open_gaps) if g >= size]
        fresh = total([*open_gaps, 40 - size])
        if sequence == len(open_gaps):
            open_gaps.append(40 - size)
            assert size == 40 or not choices or fresh <= min(choices)
        else:
            open_gaps[sequence] -= size
            assert total(open_gaps) == min([*choices, fresh])
    assert open_gaps == gaps.tolist()


def test_special_tokens_and_white_space():
    texts = ["a <|endoftext|> b", "<|endoftext|>x", "  a\n b <| ", " lead", "trail ", "a\n b", "a \nb", "", "a\x1c b", "é  日 x"]
    coder = packing.Tokens(queries.VOCABULARY, queries.PATTERN)
    want = [e.ids for e in Tokenizer.from_file(queries.VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert [a.tolist() for a in coder.encode(texts)] == want


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    import base64

    with open(queries.MULTI_RANKS, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merge_replay(reference):
    rnd = random.Random(5)
    parts = ["a", "b", "aa", " ", "  ", "\n", " \n", "\t", "é", "日", "1", "22", "'s", "'", "!", "\x85", "\xa0", "\x1c", "the", "er", "😀", "aaaaaaa"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(4000)]
    coder = bpe.Encoder(queries.MULTI_RANKS, queries.PATTERN)
    assert [a.tolist() for a in coder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_round_trip(spark, rows, reference):
    got = collections.Counter(map(tuple, bpe.round_trip(frame(spark, rows), queries.MULTI_RANKS, queries.PATTERN).collect()))
    want = collections.Counter()
    for i, t in rows:
        found = reference.encode_ordinary(t or "")
        joined = ",".join(map(str, found)).encode()
        want[(i, len(found), hashlib.sha256(joined).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want


def test_encode_decode(spark, rows, reference):
    made = bpe.decode(bpe.encode(frame(spark, rows), queries.MULTI_RANKS, queries.PATTERN), queries.MULTI_RANKS)
    for r in made.collect():
        assert r.ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()


# Quality rules


def test_quality_counts(spark, rows):
    given = rows + [(7000 + i, t) for i, t in enumerate(["a b\na b\n\n \na b", "x #$ | y <> &", "one! two? three!"])]
    got = collections.Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_rules.verdicts(frame(spark, given)).collect()
    )
    want = collections.Counter()
    for i, t in given:
        t = t or ""
        words = WORD.findall(t)
        n = len(words)
        lines = [line for line in t.split("\n") if WORD.search(line)]
        runs = collections.Counter(tuple(words[p : p + 8]) for p in range(n - 7))
        hit = {q for p in range(n - 7) if runs[tuple(words[p : p + 8])] > 1 for q in range(p, p + 8)}
        want[(i, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n)] += 1
    assert got == want


def test_adaptive_fences(spark):
    """A share of symbols that is usual in one source is rejected in another."""
    rnd = random.Random(2)
    words = vocabulary(rnd, 200)
    plain = [(i, " ".join(rnd.choices(words, k=60)), "en", "web") for i in range(800)]
    code = [(1000 + i, " ".join(w + ("#" if rnd.random() < 0.8 else "") for w in rnd.choices(words, k=60)), "en", "code") for i in range(800)]
    odd = [(3000, " ".join(w + "#" for w in rnd.choices(words, k=60)), "en", "web"), (3001, " ".join(w + "###" for w in rnd.choices(words, k=60)), None, None)]
    df = spark.createDataFrame(plain + code + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.verdicts(df).collect()}
    assert all(kept[i] for i, *_ in plain + code) and not kept[3000]
    assert 3001 in kept


def judged(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return {r.doc_id for r in quality_rules.verdicts(df).where("kept").collect()}


def test_small_sources_lean_on_their_language(spark):
    """A script without spaces, spread over small sources beside a dominant language."""
    rnd = random.Random(9)
    words = vocabulary(rnd, 200)
    plain = [(i, " ".join(rnd.choices(words, k=60)), "en", "web", 0) for i in range(300)]
    wide = [(1000 + i, " ".join("".join(rnd.choices("日本語文字漢", k=rnd.randint(30, 50))) for _ in range(30)), "ja", f"s{i % 6}", 0) for i in range(600)]
    odd = [(9000, " ".join("".join(rnd.choices("日本語文字漢", k=900)) for _ in range(30)), "ja", "s1", 0)]
    assert judged(spark, plain + wide + odd) == {r[0] for r in plain + wide}


def test_limits_do_not_leap_with_the_number_of_documents(spark):
    """A source of 49 and one of 50 documents have nearly the same limits."""
    limits = []
    for n in (49, 50, 51):
        rnd = random.Random(3)
        words = vocabulary(rnd, 200)
        web = [(i, " ".join(rnd.choices(words, k=60)), "en", "web", 0) for i in range(200)]
        code = [(1000 + i, " ".join(w + "#" * (i % 3) for w in rnd.choices(words, k=60)), "en", "code", 0) for i in range(n)]
        df = spark.createDataFrame(web + code, "doc_id long, text string, lang string, source string, n_chars long")
        counts = quality_rules.measured(df, [], "doc_id", "text").withColumn("base_failed", F.lit(False))
        group, language, everything = quality_rules.fences(quality_rules.sketches(counts))
        own, wider = (d.where(w).first()["symbols_most"] for d, w in ((group, "source = 'code'"), (everything, "true")))
        docs = group.where("source = 'code'").first()["docs"]
        row = spark.range(1).select(quality_rules.blended(F.lit(docs), F.lit(own), F.lit(wider).cast("double")).alias("x")).first()
        limits.append(row.x)
    assert wider < limits[0] < own
    assert max(limits) - min(limits) < 0.05 * (own - wider)


def test_sketches_merge(spark):
    """Quantiles lie within a sixteenth of the exact ones, and parts add up to the whole."""
    rnd = random.Random(4)
    values = [int(rnd.lognormvariate(5, 1)) for _ in range(3000)]
    df = spark.createDataFrame([("en", f"s{i % 7}", "m", v) for i, v in enumerate(values)], "lang string, source string, measure string, value long")
    sketch = df.groupBy("lang", "source", "measure", F.expr(quality_rules.bucket("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("docs"))
    row = quality_rules.quartiles(quality_rules.merged(sketch), []).first()
    exact = sorted(values)
    for got, want in ((row.low, exact[749]), (row.high, exact[2249])):
        assert want * 15 / 16 - 1 <= got <= want
    assert row.docs == 3000


# Repeated byte strings


def removed_bytes(docs, length):
    starts = collections.Counter()
    raw = [(t or "").encode() for _, t in docs]
    for b in raw:
        starts.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        hit = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if starts[b[p : p + length]] > 1:
                hit[p : p + length] = True
        out.append(hit)
    return out


def expected_suffix(rows, length):
    docs = documents(rows)
    want = {}
    for doc, hit in zip(docs, removed_bytes(docs, length)):
        raw = (doc[1] or "").encode()
        rest = bytes(b for b, gone in zip(raw, hit) if not gone)
        want[doc] = (len(raw), int(hit.sum()), len(anchors.as_runs(hit)), hashlib.sha256(rest).hexdigest())
    return collections.Counter((i, *want[(i, t)]) for i, t in rows)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_arrays(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    got = suffix.without_repeats(frame(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert collections.Counter(map(tuple, got.collect())) == expected_suffix(rows, 200)


@pytest.mark.parametrize("shard", [200, 900, 1 << 20])
def test_shards_merge_by_binary_search(monkeypatch, shard):
    """However the stretches of an anchor are cut to shards, the same windows are found."""
    monkeypatch.setattr(suffix, "SHARD", shard)
    rnd = random.Random(6)
    length = 12
    stretches = []
    for anchor in range(6):
        common = bytes(rnd.choices(b"ab", k=30))
        for i in range(1 if anchor == 5 else 25):
            content = common[: rnd.randint(0, 30)] + bytes(rnd.choices(b"abc", k=rnd.randint(length, 40)))
            stretches.append((anchor, b"%d-%d" % (anchor, i), content, len(content) - length + 1, i == 3))
    shards = suffix.Shards(length)
    made = [x for s in stretches for x in shards.add(*s)] + list(shards.close(None)) + list(shards.flush())
    seen = {}
    for anchor, _, content, count, _ in stretches:
        for p in range(count):
            key = content[p : p + length]
            seen.setdefault(key, []).append(anchor)
    assert len(made) == len(stretches)
    where = {(s[0], s[1]): s for s in stretches}
    for anchor, key, hits, several in made:
        _, _, content, count, flag = where[(anchor, key)]
        assert several == flag
        want = [seen[content[p : p + length]].count(anchor) > 1 for p in range(count)]
        # Windows of different anchors never match in real use; here they may within a shard.
        assert all(h for h, w in zip(hits.tolist(), want) if w)
        assert all(len(seen[content[p : p + length]]) > 1 for p in np.flatnonzero(hits))


def test_suffix_order_and_prefixes():
    rnd = random.Random(7)
    data = np.frombuffer(bytes(rnd.choices(b"ab", k=600)), dtype=np.uint8)
    left = 600 - np.arange(600)
    order, _ = suffix.sorted_suffixes(data, left, np.arange(600), 12)
    raw = data.tobytes()
    keys = [raw[p : p + 12] for p in order]
    assert keys == sorted(keys)
    counts = collections.Counter(raw[p : p + 12] for p in range(589))
    assert sorted(order.tolist()) == [p for p in range(589) if counts[raw[p : p + 12]] > 1]
    shared = suffix.common_prefixes(data, left, order)
    for i in range(1, len(order)):
        a, b = raw[order[i - 1] :], raw[order[i] :]
        want = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == want


def test_prefixes_begin_anew_after_pairs_that_share_nothing():
    """Neighbours A:P and B:P share no byte, the pairs one byte further on share 200."""
    rnd = random.Random(8)
    passage, tail, other, last = ("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (230, 40, 40, 40))
    contents = [(a + passage + b).encode() for a, b in (("A:", other), ("A:", tail), ("B:", tail), ("B:", last))]
    counts = [len(c) - 199 for c in contents]
    _, begins, hit = suffix.repeated_starts(contents, counts, 200)
    seen = collections.Counter(c[p : p + 200] for c, n in zip(contents, counts) for p in range(n))
    for c, b, n in zip(contents, begins.tolist(), counts):
        assert hit[b : b + n].tolist() == [seen[c[p : p + 200]] > 1 for p in range(n)]


def test_repeats_behind_two_prefixes(spark):
    rnd = random.Random(8)
    passage, tail, other, last = ("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (230, 40, 40, 40))
    given = list(enumerate(a + passage + b for a, b in (("A:", other), ("A:", tail), ("B:", tail), ("B:", last))))
    got = suffix.without_repeats(frame(spark, given)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert collections.Counter(map(tuple, got.collect())) == expected_suffix(given, 200)


# Repeated words


@pytest.mark.parametrize("hot", [20_000, 1])
def test_seed_and_extend(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(anchors, "HOT", hot)
    given = [r for r in rows if r[0] is not None]
    got = extend.without_later_repeats(frame(spark, given)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    seen, want = set(), {}
    for i, t in sorted(documents(given), key=lambda r: r[0]):
        words = WORD.findall(t or "")
        gone = set()
        for p in range(len(words) - 19):
            key = tuple(words[p : p + 20])
            if key in seen:
                gone.update(range(p, p + 20))
            seen.add(key)
        left = [w for q, w in enumerate(words) if q not in gone]
        want[(i, t)] = (i, len(words), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest())
    assert collections.Counter(map(tuple, got)) == collections.Counter(want[r] for r in given)


def test_null_ids_come_first(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = {r.doc_id: r.n_removed for r in extend.without_later_repeats(frame(spark, [(5, text), (None, text)])).collect()}
    assert got == {None: 0, 5: 30}


def test_anchors_follow_the_text():
    """Equal windows own equal anchors at equal places, wherever they stand."""
    rnd = random.Random(8)
    shared = bytes(rnd.choices(b"abcd", k=90))
    units = anchors.Units(words=False, length=40, gram=8)
    texts = [bytes(rnd.choices(b"abcd", k=rnd.randint(0, 60))) + shared + bytes(rnd.choices(b"abcd", k=20)) for _ in range(6)]
    doc, anchor, start, count, at, sizes = anchors.stretches(units, texts)
    owned = collections.defaultdict(set)
    for d, a, s, c, p in zip(doc, anchor, start, count, at):
        for w in range(c):
            owned[texts[d][s + w : s + w + 40]].add((int(a), int(p - w)))
    assert all(len(v) == 1 for v in owned.values())
    assert sum(count) == sum(max(0, len(t) - 39) for t in texts) and sizes.tolist() == list(map(len, texts))


def test_very_long_texts_are_searched_in_parts(monkeypatch):
    rnd = random.Random(9)
    units = anchors.Units(words=False, length=20, gram=5)
    text = bytes(rnd.choices(b"abc", k=700))
    whole = anchors.stretches(units, [text])
    monkeypatch.setattr(anchors, "PLACE_BITS", 7)
    parts = anchors.stretches(units, [text])
    windows = lambda s: sorted((int(b) + w, int(p) - w) for b, c, p in zip(s[2], s[3], s[4]) for w in range(c))
    assert windows(parts) == windows(whole)


# N-gram join


def set_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[p : p + 4]) for p in range(len(words) - 3)) if len(words) >= 4 else frozenset([tuple(words)])


def expected_groups(rows):
    docs = documents(rows)
    sets = [set_of(t) for _, t in docs]
    above = list(range(len(docs)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    least = {}
    rank = lambda x: (x is not None, x)
    for k, (i, _) in enumerate(docs):
        least[top(k)] = min(least.get(top(k), i), i, key=rank)
    of = {doc: (len(sets[k]), least[top(k)]) for k, doc in enumerate(docs)}
    return collections.Counter((i, *of[(i, t)]) for i, t in rows)


def near_copies(seed, n=60):
    """Copies with edits of every size around the threshold, and a passage that all share."""
    rnd = random.Random(seed)
    words = vocabulary(rnd, 400)
    common = rnd.choices(words, k=40)
    out = []
    for i in range(n):
        base = rnd.choices(words, k=rnd.randint(20, 120))
        out.append(" ".join(base + common))
        for _ in range(rnd.randint(0, 3)):
            edited = list(base)
            for _ in range(rnd.randint(0, 5)):
                edited[rnd.randrange(len(edited))] = rnd.choice(words)
            out.append(" ".join(edited + common))
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("block", [2048, 5])
def test_ngram_join(spark, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    given = rows + [(i + 20_000, t) for i, t in near_copies(1)]
    got = ngram_join.similar(frame(spark, given)).collect()
    assert collections.Counter(map(tuple, got)) == expected_groups(given)


def test_ngram_join_without_words(spark):
    given = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a B"), (None, "a b")]
    got = ngram_join.similar(frame(spark, given)).collect()
    assert collections.Counter(map(tuple, got)) == expected_groups(given)


def test_components(spark):
    rnd = random.Random(11)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(60)]
    above = {x: x for link in links for x in link}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: top(x) for x in above if top(x) != x}


# Embeddings


def cloud(seed, n=150, size=64):
    rnd = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        x = rnd.standard_normal(size)
        out.append(x)
        for _ in range(rnd.integers(0, 3)):
            out.append(x + rnd.standard_normal(size) * rnd.uniform(0.05, 0.6))
    return [np.asarray(x, dtype=np.float32).tolist() for x in out]


def expected_links(vectors, cosine=0.9):
    usable = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if ok else None for v, ok in zip(vectors, usable)]
    return {
        (i, j) for i in range(len(unit)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine
    }


@pytest.mark.parametrize("block", [2048, 3])
def test_lattice(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    vectors = cloud(3, 60)
    vectors += [vectors[0]] * 4 + [[2 * c for c in vectors[1]], [0.0] * 64, None, [], [float("nan")] * 64, [None] + [1.0] * 63, [1.0, 0.0], [1.0, 0.1], [3e38] * 64]
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, key int").repartition(3)
    got = {r.vec_id: r for r in lattice.near_duplicates(df.unionAll(df.where("vec_id = 7"))).collect()}
    links = expected_links(vectors)
    assert len(got) == len(vectors)
    assert sum(r.n_links for r in got.values()) >= 0.97 * 2 * len(links)
    degree = collections.Counter(x for link in links for x in link)
    assert all(r.n_links <= degree[r.vec_id] for r in got.values())
    for i, r in got.items():
        assert r.kept == (r.component_id == i) and (r.n_links > 0 or r.component_id == i)
        assert got[r.component_id].component_id == r.component_id


def test_lattice_recall(spark):
    vectors = cloud(4, 300)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    found = sum(r.n_links for r in lattice.near_duplicates(df).collect())
    assert found >= 0.98 * 2 * len(expected_links(vectors))


def test_lattice_points():
    x = np.random.default_rng(1).standard_normal((500, 8)) * 2
    found = lattice.nearest_point(x)
    twice = np.rint(found * 2).astype(int)
    assert np.allclose(found * 2, twice) and ((twice % 2 == twice[:, :1] % 2).all()) and (twice.sum(axis=1) % 4 == 0).all()
    roots = lattice.neighbours()
    assert len(np.unique(roots, axis=0)) == 240 and np.allclose((roots**2).sum(axis=1), 2)
    # No neighbour is nearer than the point found.
    gap = ((x - found) ** 2).sum(axis=1)
    assert (((x[:, None, :] - found[:, None, :] - roots[None]) ** 2).sum(axis=2) >= gap[:, None] - 1e-9).all()


# Grades


def test_grades(spark):
    """Held-out accuracy on the provided labels, and thresholds in order."""
    spark_docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0
    model = grades.train(spark_docs, labels.where(~held), grade, 2)
    assert (np.diff(model.thresholds) > 0).all()
    rated = labels.where(held).withColumn("grade", grade)
    kept = {r.grade: r.kept for r in grades.graded(spark_docs, model).join(rated, "doc_id").groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[2] > 0.97 and kept[1] < 0.15 and kept[0] < 0.2


def test_grades_of_odd_rows(spark, rows):
    labels = spark.createDataFrame([(r[0], i % 3) for i, r in enumerate(rows)] + [(None, 1), (3, None)], "doc_id long, grade int")
    model = grades.train(frame(spark, rows), labels, F.col("grade"), 2)
    got = grades.graded(frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.tail <= r.expected_grade <= 2 and r.kept == (r.tail >= 0.5) for r in got)


def test_ratings_that_tell_nothing_are_left_out(spark):
    """Null and unknown grades, and labels without a document, don't enter the sample."""
    docs = spark.createDataFrame([(i, f"word{i} text") for i in range(6)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 3), (3, -1), (4, 2), (4, 0), (None, 1), (99, 1)], "doc_id long, g int")
    found = grades.sample_of(docs, labels, F.col("g"), 2, 100, "doc_id", "text")
    assert [(r["doc_id"], r["grade"]) for r in found] == [(0, 1), (4, 0)]


def test_sample_is_bounded_by_documents(spark):
    """One labelled id with many rows and texts stays within the bound."""
    docs = spark.createDataFrame([(7, f"text {i % 300}") for i in range(3000)] + [(8, "one")], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, g int")
    assert len(grades.sample_of(docs, labels, F.col("g"), 2, 10, "doc_id", "text")) == 10
    assert len(grades.sample_of(docs, labels, F.col("g"), 2, 1000, "doc_id", "text")) == 301


def test_likelihood_and_gradient():
    """Against the plain product of chances, and its differences."""
    rnd = np.random.default_rng(3)
    n, features, top = 40, 12, 3
    docs, cols = np.repeat(np.arange(n), 4), rnd.integers(0, features, 4 * n)
    rated = rnd.integers(0, top + 1, n)
    weights, free = rnd.normal(size=features), np.array([-0.5, 0.2, -0.3])

    def plain(weights, free):
        cuts = [free[0], free[0] + np.exp(free[1]), free[0] + np.exp(free[1]) + np.exp(free[2])]
        total = 0.0
        for d in range(n):
            score = sum(weights[c] for c in cols[docs == d])
            at_least = [1.0, *[1 / (1 + np.exp(c - score)) for c in cuts], 0.0]
            total -= np.log(at_least[rated[d]] - at_least[rated[d] + 1])
        return total / n

    loss, gradient = grades.loss_and_gradient(weights, free, docs, cols, rated)
    assert abs(loss - plain(weights, free)) < 1e-9
    every = np.concatenate([weights, free])
    for i in range(len(every)):
        step = np.zeros(len(every))
        step[i] = 1e-5
        up, down = every + step, every - step
        slope = (plain(up[:features], up[features:]) - plain(down[:features], down[features:])) / 2e-5
        assert abs(slope - gradient[i]) < 1e-6


# URL rules


def expected_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("size", [500_000, 7])
def test_urls(spark, monkeypatch, size):
    monkeypatch.setattr(urls, "RANGE", size)
    rnd = random.Random(12)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "net", "x.net", "example.net", "xcom", "WWW.Example.COM", "", "com.", ".com", "example.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/x?y=/es/", "/es/1#t", "/fr/", "?q", "#f", "/en/a\nb"]
    given = [rnd.choice(["http://", "https://", "", "://"]) + rnd.choice(hosts) + rnd.choice(paths) for _ in range(300)]
    given += [None, "", "http://www.example.com/en/"] + ["http://www.example.com/en/hot"] * 60
    pages = spark.createDataFrame([(i if i % 9 else None, u, "x") for i, u in enumerate(given)], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.URL_RULES + [(None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string")
    got = collections.Counter(map(tuple, urls.judge(pages, rules).collect()))
    assert got == collections.Counter((i if i % 9 else None, *expected_url(u, queries.URL_RULES)) for i, u in enumerate(given))


def test_many_nested_rules(spark):
    rnd = random.Random(13)
    labels = ["a", "b", "c"]
    names = [".".join(rnd.choices(labels, k=rnd.randint(1, 4))) for _ in range(60)]
    rules = {(n, "/" + "/".join(rnd.choices(labels, k=rnd.randint(0, 2)))): rnd.choice(["allow", "block"]) for n in names}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    given = ["s://" + ".".join(rnd.choices(labels, k=rnd.randint(1, 5))) + "/" + "/".join(rnd.choices(labels, k=3)) for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((i, *expected_url(u, rules)) for i, u in enumerate(given))


# Sentence pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def test_pieces_equal_the_library(library):
    """Awkward texts, random letters, and texts put together from pieces."""
    rnd = random.Random(6)
    parts = ["a", "aa", " ", "  ", " " * 20, "\n", "\t", "é", "日本", "22", "!", "\x00", "▁", "the", "ing", "😀", "<s>", "</s>", "<unk>", "<0x41>", "́", "Ａ"]
    pool = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choices(pool, k=rnd.randint(1, 20))) for _ in range(1500)] + ["日本語" * 9000 + "aab" * 9000]
    coder = pieces.Encoder(queries.PIECES)
    want = library.encode(texts)
    got = coder.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [coder.model.decode(g) for g in got] == library.decode(want)


def test_pieces_decode_any_ids(library):
    rnd = random.Random(7)
    ids = [[rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000), rnd.randrange(4)]) for _ in range(rnd.randint(0, 12))] for _ in range(3000)]
    model = pieces.encoder(queries.PIECES).model
    assert [model.decode(np.array(i, dtype=np.int64)) for i in ids] == library.decode(ids)


def test_pieces_by_row(spark, rows, library):
    got = collections.Counter(map(tuple, pieces.round_trip(frame(spark, rows), queries.PIECES).collect()))
    want = collections.Counter()
    for i, t in rows:
        found = library.encode(t or "")
        want[(i, len(found), hashlib.sha256(",".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(library.decode(found).encode()).hexdigest())] += 1
    assert got == want
    made = pieces.decode(pieces.encode(frame(spark, rows), queries.PIECES), queries.PIECES).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in made) == collections.Counter((i, t or "") for i, t in rows)


# Periodic runs


def brute_runs(words):
    """Maximal runs ``(start, length, period)`` by comparing the words at every distance."""
    codes = {}
    c = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.int64)
    seen = {}
    for q in range(1, len(c) // 3 + 1):
        step = np.diff(np.concatenate([[0], (c[:-q] == c[q:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if b + q - a >= max(24, 3 * q):
                seen.setdefault((a, b + q), q)
    return sorted(((a, b - a, q) for (a, b), q in seen.items()), key=lambda r: (r[0], r[2]))


def expected_runs(text):
    from fractions import Fraction

    words = WORD.findall(text or "")
    runs = brute_runs(words)
    gone = {p for a, n, q in runs for p in range(a + q, a + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    left = " ".join(w for p, w in enumerate(words) if p not in gone)
    return len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(), len(words)


def periodic_texts(seed, n=60):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(1, 6)):
            q = rnd.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 48, 64, 65])
            base = [f"w{rnd.randrange(2 if rnd.random() < 0.5 else 50)}" for _ in range(q)]
            n_words = rnd.randint(1, 6 * q)
            words += (base * (n_words // q + 1))[:n_words]
            if rnd.random() < 0.3:
                words[rnd.randrange(len(words))] = "odd"
            words += [f"x{rnd.randrange(1000)}" for _ in range(rnd.choice([0, 0, 1, 5]))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("tile, span", [(1024, 8), (32, 1), (64, 2)])
def test_periodic_runs(spark, rows, monkeypatch, tile, span):
    """Runs within, across and at the ends of tiles, beside the awkward rows."""
    monkeypatch.setattr(periods, "TILE", tile)
    monkeypatch.setattr(periods, "SPAN", span)
    given = rows + [(30_000 + i, t) for i, t in enumerate([*periodic_texts(tile), "a " * 5000, "a b\n" * 24, "b " * 23])]
    got = periods.periodic_runs(frame(spark, given)).drop("runs").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((i, *expected_runs(t)) for i, t in given)


def test_z_function():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        words = rnd.integers(0, 2, rnd.integers(1, 40)).astype(np.int32)
        want = [next((k for k in range(len(words) - s) if words[k] != words[s + k]), len(words) - s) for s in range(1, len(words))]
        assert periods.z_function(words, len(words))[1:] == want


# Ranked search


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(docs, items, most):
    import math

    def found(text):
        return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, collections.Counter(found(t))) for i, t in docs]
    n_all = sum(bool(c) for _, c in held)
    l_all = sum(sum(c.values()) for _, c in held)
    df = collections.Counter(term for _, c in held for term in c)
    out = collections.Counter()
    for item, text in items:
        scores = []
        for i, c in held:
            n = sum(c.values())
            score = 0
            for term in set(found(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[term] + 1)))
                score += w * (10**9 * c[term] // (1000 * c[term] + 20 * (50 + 50 * n * n_all // l_all)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out.update((item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores)[:most], 1))
    return out


@pytest.mark.parametrize("tile, block, exact", [(200_000, 4_000_000, 1 << 53), (30, 900, 1 << 34)])
def test_ranked(spark, rows, monkeypatch, tile, block, exact):
    """Also in many tiles and blocks, with sums cut to a few terms, ties and repeated rows."""
    monkeypatch.setattr(ranking, "TILE", tile)
    monkeypatch.setattr(ranking, "BLOCK", block)
    monkeypatch.setattr(ranking, "EXACT", exact)
    texts = [t for _, t in rows if t]
    items = [(k, " ".join(texts[k % len(texts)].split()[: 3 + k % 9])) for k in range(12)] + [(50, None), (51, " - "), (52, "nowhere found"), (None, texts[3][:60]), (0, "ab")]
    asked = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, score string")
    got = ranking.ranked(frame(spark, rows), asked, most=5).collect()
    assert collections.Counter(map(tuple, got)) == expected_ranks(rows, items, 5)


def test_products_are_exact():
    """Sums beyond 2^53 are added up in parts."""
    impact = np.full((2, 40), 999_983.0)
    weight = np.full((40, 3), 2.0**33 - 1)
    got = ranking.products(impact, weight, 2**33 - 1)
    assert (got == 40 * 999_983 * (2**33 - 1)).all()


def test_empty_tables_of_the_new_operators(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    made = [
        pieces.round_trip(none, queries.PIECES), periods.periodic_runs(none), ranking.ranked(none, items),
        ranking.ranked(spark.createDataFrame([(1, None)], "doc_id long, text string"), items),
        ranking.ranked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)),
    ]
    assert [df.count() for df in made] == [0] * len(made)
