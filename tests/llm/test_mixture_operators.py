"""Filter audit, byte-pair encoding and resampling, each against a plain version."""
import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import plain
from cases import SF, got, odd_texts, want
from ledgerloom.llm import byte_pairs, filter_audit, queries, resampling

PATH = plain.public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = byte_pairs.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=plain.public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BOTH = pytest.mark.parametrize("which", ["documents", "odd", "none"])
SORTED = st.lists(st.integers(0, 60), unique=True).map(sorted)
AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.fixture
def case(which, request):
    rows = [] if which == "none" else request.getfixturevalue({"documents": "document_rows", "odd": "odd_rows"}[which])
    return request.getfixturevalue(which), rows


@given(st.lists(SORTED, max_size=5), SORTED)
def test_sorted_lists(lists, ids):
    every = set().union(*lists)
    assert filter_audit.union(lists) == sorted(every)
    assert filter_audit.difference(ids, sorted(every)) == sorted(set(ids) - every)
    assert filter_audit.common(ids, sorted(every)) == len(set(ids) & every)
    for value in range(62):
        for at in range(len(ids) + 1):
            assert at == len(ids) or filter_audit.skip(ids, value, at) == max(at, sum(x < value for x in ids))


@pytest.mark.parametrize("which", ["documents", "odd", "none"])
@pytest.mark.parametrize("range_ids", [filter_audit.RANGE_IDS, 3])
def test_audit(which, range_ids, request, spark):
    docs = request.getfixturevalue(which)
    labels = [(i, i % 2, None if i == 4 else int(i % 3 == 0)) for i in range(41)] + [(None, 1, 1), (7, 1, 0), (7, None, None), (900, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.select("doc_id", "text", "source").collect()]
    found = filter_audit.audit(filter_audit.failures(docs, table), range_ids=range_ids)
    assert got(found, *AUDIT) == want(plain.audit(rows, labels))


def test_audit_of_few_filters_and_no_labels(odd, odd_rows, spark):
    failing = filter_audit.failures(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd.select("doc_id", "text", "source").collect()]
    assert got(filter_audit.audit(failing, "DBE"), *AUDIT) == want(plain.audit(rows, [], "DBE"))


@BOTH
def test_byte_pairs(case):
    docs, rows = case
    found = queries.op12_digest(byte_pairs.encode(docs, PATH), PATH)
    expected = []
    for d, t in rows:
        ids = LIBRARY.encode_ordinary(t or "")
        expected.append((d, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(t or "")))
    assert got(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want(expected)


def test_byte_pairs_of_rare_characters_and_small_lists(spark, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(chr(c) for c in range(a, min(a + 3000, 0x110000)) if not 0xD800 <= c < 0xE000) for a in range(0, 0x110000, 3000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABC0189+/", k=n)) for n in (100, 255, 256, 257, 3000, 50_000)]
    texts += ["".join(rng.choices("ab \n", k=n)) for n in (100, 2000)] + ["=" * 257, "=" * 256, " " * 300, "aaa" * 50]
    expected = [LIBRARY.encode_ordinary(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    for words in (byte_pairs.LIST_WORDS, 10):
        monkeypatch.setattr(byte_pairs, "LIST_WORDS", words)
        monkeypatch.setattr(byte_pairs, "ROW_WORDS", min(words, byte_pairs.ROW_WORDS))
        found = byte_pairs.encode(docs, PATH)
        found = {r["doc_id"]: r for r in found.select("doc_id", "ids", byte_pairs.decode(found["ids"], PATH).alias("bytes")).collect()}
        assert [found[i]["ids"] for i in range(len(texts))] == expected
        assert [bytes(found[i]["bytes"]) for i in range(len(texts))] == [t.encode() for t in texts]


def test_rare_characters_are_looked_for_in_new_words_only(monkeypatch):
    looked, usual = [], plain.public_tokenizers.PATTERN
    monkeypatch.setattr(byte_pairs, "_is_odd", lambda word, real=byte_pairs._is_odd: looked.append(word) or real(word))
    known, odd = set(), set()
    for texts in (["it's a x² text", "a text"], ["a x² text", "it's\u1369 a"], ["a x² text, it's", "a\x85 text"], ["a text", ""]) * 2:
        looked.clear()
        cut, new = byte_pairs.words_of(texts, usual, usual, known, odd)
        assert cut == [byte_pairs._pattern(usual).findall(t) for t in texts]
        assert new == set().union(*cut) - known and known.isdisjoint(looked)
        known |= new


def test_fold_by_whole_array_functions(spark):
    rng = random.Random(3)
    words = [t.encode()[:256] for t in odd_texts() if t and len(t) > 1] + [rng.choice(["a", "ab", "the ing"]).encode() * n for n in range(1, 36)] + [bytes(rng.choices(range(256), k=n)) for n in range(1, 60)]
    single = byte_pairs.np.array([RANKS[bytes([b])] for b in range(256)], "int64")
    lengths, flat = byte_pairs.start_parts(words, byte_pairs.start_ranks(RANKS), single)
    parts = [x.tolist() for x in byte_pairs.np.split(flat, lengths.cumsum()[:-1])]
    rows = spark.createDataFrame([(parts,)], "words array<array<bigint>>")
    use = lambda table: F.transform("words", lambda x: byte_pairs.folded(x, table))
    fold = byte_pairs._with(byte_pairs.rank_map(RANKS), F.col("words"), use)
    found = [[x & byte_pairs.PAIR - 1 for x in word] for word in rows.select(fold).head()[0]]
    assert found == [[byte_pairs.PAIR - 1, *byte_pairs.heap_merges(word, RANKS)] for word in words]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_heap_merges(name):
    ranks = byte_pairs.read_ranks(plain.public_tokenizers.path(name))
    library = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for text in [t for t in odd_texts() if t] + ["a" * n for n in range(1, 40)]:
        if text.encode() not in ranks:
            assert byte_pairs.heap_merges(text.encode(), ranks) == library.encode_ordinary(text)


def test_byte_pairs_of_another_vocabulary_and_pattern(spark):
    path, pattern = plain.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), r"\p{L}+|\P{L}+"
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_pairs.read_ranks(path), special_tokens={})
    texts = [t for t in odd_texts() if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "n long, body string")
    found = dict(map(tuple, byte_pairs.encode(docs, path, pattern, key="n", text="body").collect()))
    assert [found[i] for i in range(len(texts))] == [library.encode_ordinary(t) for t in texts]


def test_decoding_of_unknown_ids(spark):
    rows = spark.createDataFrame([([64, 70_000, None, 65],), ([],), (None,)], "ids array<int>")
    assert [r[0] and bytes(r[0]) for r in rows.select(byte_pairs.decode(rows["ids"], PATH)).collect()] == [b"ab", b"", None]


@BOTH
@pytest.mark.parametrize("percent, least", [(5, 20), (50, 0)])
def test_resampling(case, percent, least, spark):
    docs, rows = case
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [(None, "a\nb c\n\nd"), (1, None), (1, "")]
    target = spark.createDataFrame(items, "item_id long, text string")
    expected = plain.resampled(rows, items, percent, least)
    found = got(resampling.resample(docs, target, percent, least), "doc_id", "n_features", "weight", "score", "rank")
    tied = {r[:4] for r in expected if expected.count(r) > 1 or sum(x[:4] == r[:4] for x in expected) > 1}  # rows of one key and text: any order
    assert [r for r in found if r[:4] not in tied] == [r for r in want(expected) if r[:4] not in tied]
    assert sorted((repr(r) for r in found if r[:4] in tied)) == sorted(repr(r) for r in expected if r[:4] in tied)


def test_resampling_without_a_target(documents, document_rows, spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert got(resampling.resample(documents, empty), "doc_id", "n_features", "weight", "score", "rank") == want(plain.resampled(document_rows, []))


@pytest.mark.parametrize("text", ["", "\n", "a", "a\nb", "a b\nc\nd e f\n\n!\ng", "\n".join("abcdefgh"), "a b c d e f g h"])
def test_lines_and_crossings_are_all_features(text):
    lines = resampling.lines_of(text.encode())
    words = [w for line in lines for w in line]
    _, within = resampling.line_features([b" ".join(x) for x in lines], 1 << 40)
    expected = [c for some in resampling.grams(words) for c in some]
    assert sorted([*within.tolist(), *resampling.crossing(lines)]) == sorted(expected)
    assert len(expected) == sum(max(0, len(words) - k) for k in range(3))


def test_ranks_over_many_parts(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x"), F.lit(None).cast("int").alias("y")).repartition(9)
    found = resampling.ranked(rows, F.desc("x")).collect()
    assert sorted((r["rank"], r["x"]) for r in found) == [(i + 1, 4999 - i) for i in range(5000)]


def test_digest_is_wide_enough():
    assert len(resampling.digest(b"a")) == 16 and resampling.digest(b"a") == hashlib.blake2b(b"a", digest_size=16).digest()
