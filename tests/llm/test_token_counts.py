import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import token_counts

SCHEMA = "doc_id long, text string"
PATH = token_counts.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = token_counts.PrefixCounter(PATH)
ODD = [
    None, "", " ", " \n\t ", "a", "It's DON'T, 12 3.4!", "É. ÉTÉ x", "İstanbul. ΣΑΣ. ß ẞ ŉ áb", "<|endoftext|> a<|startoftext|>b'll", "!<|endoftext|>x <|endoftext", "z\x1cx\x85y\x0bz.w",
    "." * 50, "a,b;c:d", "語 語。日本語テキスト", "x" * 300, "they're we'LL 're 'r 'ra ''s !'s 's't'rex", "ẹ́ à́b", "각각 한국어", "<|ENDOFTEXT|>", "≮ ≯ ́x", "नमस्ते", "😀😀👩‍👩‍👧 ½²Ⅳ١٢",
    "   x　y", "ﬁ ſ K Å Ω", "a\u0000b", "'́s 'S'T", "hello  world\r\n\r\nagain", "e" + "́̀" * 20, "Zürich, naïve façade!",
]


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids) if text else 0


def prefixes(text, block=1 << 20):
    return [0, *(int(x) for _, counts in COUNTER.prefix_counts([text], block) for x in counts)]


def brute(rows, limit):
    out = []
    for d, t in rows:
        t = t or ""
        n = [count(t[:i]) for i in range(len(t) + 1)]
        out.append((-1 if d is None else d, len(t.encode()), n[-1], n[-1] > limit, max(i for i, x in enumerate(n) if x <= limit)))
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_tokens", "2 AS counts")
    return sorted((-1 if r.doc_id is None else r.doc_id, *list(r)[1:]) for r in token_counts.count_tokens(df, **more).collect())


def test_every_prefix_of_odd_texts():
    for text in ODD:
        if text:
            assert prefixes(text) == [count(text[:i]) for i in range(len(text) + 1)], text
            assert prefixes(text, block=3) == prefixes(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("abehilnorst'’ .,!<|>\n12éÉßİ́̈Σ가ᅡᆨ語")), max_size=25))
def test_every_prefix(text):
    assert prefixes(text) == [count(text[:i]) for i in range(len(text) + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aeinorstlhcd"), min_size=1, max_size=14))
def test_tokens_that_stay_apart(word):
    m = COUNTER.merges
    parts = m.merge(list(word))
    for left, right in zip(parts, parts[1:], strict=False):
        assert m.apart(left, right)
    for at in range(1, len(word)):
        left, right = word[:at], word[at:]
        if left in m.inner and right in m.inner and m.making(left) and m.making(right):
            assert m.apart(left, right) == (m.merge(list(word)) == [left, right])


def test_words_with_marks_are_learnt_together(monkeypatch):
    marks = [*(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"), "***", ",%%%", "!!", ".&&&", "),", "<|", "...!?", "a_b"]
    texts = [f"{blank}{word}{x}" for x in marks for blank, word in (("", "And"), (" \n", "çpaleÉ"))]
    slow = token_counts.PrefixCounter.counts
    taken = []
    monkeypatch.setattr(token_counts.PrefixCounter, "counts", lambda self, chunk: taken.append(chunk) or slow(self, chunk))
    counter = token_counts.PrefixCounter(PATH)
    for text in [*texts, "And<|endoftext|>", "it's,", "'s!!"]:
        got = [0, *(int(x) for _, counts in counter.prefix_counts([text]) for x in counts)]
        assert got == [count(text[:i]) for i in range(len(text) + 1)], text
    assert taken == ["Anda_b", "çpaleÉa_b", "And<|endoftext|>", "it's,", "'s!!"]  # all others without a step for each code point


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aeinorstlhcdÃ§!%,"), min_size=1, max_size=20))
def test_lengths_of_tokens_that_end_a_text(text):
    m = COUNTER.merges
    ends = [n for n in range(len(text), 0, -1) if text[-n:] in m.tokens]
    sizes = m.sizes_of(text[-token_counts.TAIL :])
    assert [n for n in sizes if text[-n:] in m.tokens and n <= len(text)] == ends
    assert set(sizes) <= {n for x in m.tokens if x.endswith(text[-token_counts.TAIL :]) for n in [len(x)]} | set(range(1, token_counts.TAIL))


def test_long_word_in_a_window(monkeypatch):
    monkeypatch.setattr(token_counts, "WINDOW", 100)
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefgh"), 3000)) + "語" * 500
    got = prefixes(text)
    for i in [*range(95, 310, 7), 2999, 3000, 3001, 3499, 3500]:
        assert got[i] == count(text[:i])


def test_equals_the_library(spark):
    rows = list(enumerate(ODD)) + [(3, "a  b"), (None, "It's me"), (2**60, "big id")]
    assert run(spark, rows, limit=5) == brute(rows, 5)
    assert run(spark, rows * 2, limit=5, block=4) == brute(rows * 2, 5)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs).collect()}
    for r in docs.collect():
        g, t = got[r.doc_id], r.text or ""
        assert (g.n_tokens, g.n_bytes, g.over_limit) == (count(t), len(t.encode()), count(t) > 2048)
        assert count(t[: g.fitting_chars]) <= 2048 and (g.fitting_chars == len(t)) == (not g.over_limit)


def test_stored_counts_answer_truncation(spark):
    rows = [(i, t) for i, t in enumerate(ODD) if t]
    stored = token_counts.prefix_counts(spark.createDataFrame(rows, SCHEMA))
    got = stored.select("doc_id", token_counts.tokens_of_prefix(F.col("counts"), F.lit(4)).alias("n"), token_counts.longest_prefix(F.col("counts"), F.lit(2)).alias("fit"))
    texts = dict(rows)
    for r in got.collect():
        t = texts[r.doc_id]
        assert r.n == count(t[:4])
        assert r.fit == max(i for i in range(len(t) + 1) if count(t[:i]) <= 2)


def test_empty_table(spark):
    assert run(spark, []) == []
