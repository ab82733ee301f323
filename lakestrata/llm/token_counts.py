"""Exact token counts of every prefix of a text, for byte-pair tokenizers that
mark word ends.

``counts[i]`` is the number of tokens that the tokenizer gives the first ``i``
code points, for every ``i``: counts of whole texts, of truncated ones and the
longest prefix within a budget are look-ups.  Nothing is encoded again for
them, as the counts come from dynamic programming over prefixes: a sequence of
tokens is what byte-pair merging gives if and only if each two neighbours stay
apart when merged alone.  So every prefix of a word has exactly one last token
that can follow the last token of the prefix before it, and its count is that
prefix's count and one.  A prefix that ends a word takes its last token from
those with the end mark; otherwise words are continued from the unmarked ones.
Whether two tokens stay apart is decided once for each pair.

What precedes merging is followed code point by code point: composition and
lower case (clusters of a base and what may combine with it), the tokenizer's
classes of letters, digits, white space and others, its contractions, and its
special tokens, whose strings count as one token, as is the library's default.
Words between blanks are kept with the differences of their counts; a text's
counts are a running sum over them.

Scale: one pass, no shuffle.  Words kept by a worker are bounded in number and
length; longer ones are worked out each time, holding a window of the last
tokens.  Texts are taken in pieces cut at blanks.  A cluster of ``m`` combining
marks takes ``m * m / 2`` steps.

Defined cases: a null or empty text has no tokens; rows that repeat are counted
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import worker_cache

LIMIT = 2048
BLOCK_CHARS = 4 << 20
KEPT_WORDS = 900_000
KEPT_LENGTH = 64  # code points of a word that is kept
KEPT_PAIRS = 1_500_000
KEPT_TAILS = 200_000
WINDOW = 4096  # positions of a word that are held before the oldest go
TAIL = 4  # symbols by which the tokens that may end somewhere are looked up

END = "</w>"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the tokenizer's pattern
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("fitting_chars", pa.int64())])
OUT_DDL = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long"

_PIECES = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
_CUT = re.compile(r"(?<=[^ \t\r\n])(?=[ \t\r\n])")
# blanks, Latin letters that composition and lower case take one by one, and marks;
# none that a contraction begins with
_PLAIN = re.compile(r"([ \t\r\n]{0,4})([A-Za-zÀ-ÖØ-öø-ÿ]{1,50})([!-&(-/:-@\[-`{-~]{0,10})")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """Which tokens stay apart, from the merges of a vocabulary.  Tokens that
    end a word carry the end mark."""

    def __init__(self, merges: list, vocabulary: dict[str, int]):
        self.rank = {tuple(x if isinstance(x, list) else x.split(" ")): i for i, x in enumerate(merges)}
        self.inner = {x for x in vocabulary if not x.endswith(END)}
        self.final = {x[: -len(END)]: x for x in vocabulary if x.endswith(END)}
        self.longest = max(map(len, [*self.inner, *self.final]))
        #: text -> (token that goes on, token that ends the word), None where there is none
        self.tokens = {x: (x if x in self.inner else None, self.final.get(x)) for x in self.inner | self.final.keys()}
        #: last symbols of a text -> lengths of the tokens that may end it, the longest first
        self.sizes: dict[str, tuple[int, ...]] = {}
        self.longer: dict[str, set[int]] = {}  # the same, of tokens from ``TAIL`` symbols on
        for x in self.tokens:
            if len(x) >= TAIL:
                self.longer.setdefault(x[-TAIL:], set()).add(len(x))
        self.made: dict[str, tuple[int, str, str] | None] = {}
        self.known: dict[tuple[str, str], bool] = {}

    def merge(self, symbols: list[str], least: int = 1) -> list[str]:
        """Byte-pair merging, for a few symbols, down to ``least`` of them."""
        none = len(self.rank)
        while len(symbols) > least:
            ranks = [self.rank.get(x, none) for x in zip(symbols, symbols[1:], strict=False)]
            first = min(ranks)
            if first == none:
                break
            at = ranks.index(first)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def sizes_of(self, tail: str) -> tuple[int, ...]:
        """Lengths of the tokens that may end a text with these last ``TAIL``
        symbols (or this whole text, if shorter), the longest first."""
        found = self.sizes.get(tail)
        if found is None:
            if len(self.sizes) > KEPT_TAILS:
                self.sizes.clear()
            short = [n for n in range(1, min(len(tail) + 1, TAIL)) if tail[-n:] in self.tokens]
            found = self.sizes[tail] = tuple(sorted([*self.longer.get(tail, ()), *short], reverse=True))
        return found

    def making(self, token: str) -> tuple[int, str, str] | None:
        """The merge that makes a token, as (rank, left, right); rank -1 for a
        single symbol; None where merging its symbols gives something else."""
        if token not in self.made:
            symbols = [*token[: -len(END) - 1], token[-len(END) - 1 :]] if token.endswith(END) else list(token)
            parts = self.merge(symbols, 2)
            if len(parts) == 1:
                self.made[token] = -1, token, token
            else:
                rank = self.rank.get(tuple(parts)) if len(parts) == 2 else None
                self.made[token] = None if rank is None else (rank, *parts)
        return self.made[token]

    def follows(self, before: str, token: str) -> bool:
        """Whether ``token`` can follow ``before`` ('': the start of a word)."""
        key = before, token
        found = self.known.get(key)
        if found is None:
            if len(self.known) > KEPT_PAIRS:
                self.known.clear()
            found = self.known[key] = self.making(token) is not None and (not before or self.apart(before, token))
        return found

    def apart(self, left: str, right: str) -> bool:
        """Whether two tokens, merged together, stay two.  Their merges are
        undone from the last to the first; the pieces that meet in between are
        joined if that merge comes before the next one undone."""
        rank, making = self.rank, self.making
        limit = len(rank)
        while True:
            if rank.get((left, right), limit) < limit:
                return False
            a, b = making(left), making(right)
            if a[0] > b[0]:
                limit, left = a[0], a[2]
            elif b[0] < 0:
                return True
            else:  # of equal merges the left one comes first: this pair's, then those within the right token
                limit, right = b[0] + 1, b[1]


class Word:
    """A word that grows by symbols: its tokens' counts, as far as it goes."""

    __slots__ = ("merges", "text", "counts", "last")

    def __init__(self, merges: Merges):
        self.merges, self.text, self.counts, self.last = merges, "", [0], [""]

    def push(self, symbols: str) -> None:
        m, inner, follows, last = self.merges, self.merges.inner, self.merges.follows, self.last
        for symbol in symbols:
            self.text += symbol
            text, end = self.text, len(self.text)
            for at in range(max(0, end - m.longest), end):
                token = text[at:]
                if token in inner and follows(last[at], token):
                    self.counts.append(self.counts[at] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends {text[-20:]!r}")

    def ended(self) -> int:
        """Count of the word, if it ends here."""
        m, text, end = self.merges, self.text, len(self.text)
        for at in range(max(0, end - m.longest), end):
            token = m.final.get(text[at:])
            if token and m.follows(self.last[at], token):
                return self.counts[at] + 1
        raise ValueError(f"no token ends {text[-20:]!r}")

    def trim(self) -> None:
        """Forgets all but the window that a token can reach."""
        if len(self.text) > WINDOW:
            keep = 2 * self.merges.longest
            self.text, self.counts, self.last = self.text[-keep:], self.counts[-keep - 1 :], self.last[-keep - 1 :]

    def copy(self) -> Word:
        out = Word(self.merges)
        out.text, out.counts, out.last = self.text, self.counts[:], self.last[:]
        return out


class Reader:
    """Counts of a growing text: words as the tokenizer cuts them."""

    def __init__(self, counter: PrefixCounter, base: int = 0):
        self.counter, self.base, self.word, self.kind, self.quote = counter, base, None, "", ""
        # quote: what may become a contraction, from its mark on; base holds the words before it

    def count(self) -> int:
        return self.base + (self.word.ended() if self.word else 0)

    def close(self) -> None:
        self.base, self.word, self.kind = self.count(), None, ""

    def feed(self, char: str) -> None:
        c = self.counter
        kind, quote = c.kind(char), self.quote + char
        self.quote = ""
        if len(quote) > 1 and quote in CONTRACTIONS:
            # the mark's count is in the base once letters follow it; before, its word is open
            self.base += c.alone(quote) - (c.alone(quote[0]) if len(quote) > 2 else 0)
            self.word, self.kind = None, ""
            return
        if kind != self.kind or kind == "N":
            self.close()
        if kind == "S":
            return
        if self.word is None:
            self.word, self.kind = Word(c.merges), kind
            if char == "'":
                self.quote = char
        if len(quote) > 1 and any(x.startswith(quote) for x in CONTRACTIONS):
            self.quote = quote
        self.word.push(c.symbols(char))

    def restore(self, other: Reader) -> None:
        self.base, self.word, self.kind, self.quote = other.base, other.word and other.word.copy(), other.kind, other.quote

    def copy(self) -> Reader:
        out = Reader(self.counter)
        out.restore(self)
        return out


class PrefixCounter:
    """Token counts of all prefixes by the tokenizer of a vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        self.merges = Merges(own["model"]["merges"], own["model"]["vocab"])
        specials = sorted((x["content"] for x in own["added_tokens"]), key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, specials)))
        self.known: dict[str, bytes] = {}  # steps of blanks and a word
        self.plain: dict[str, bytes] = {}  # steps of a word
        self.kinds: dict[str, str] = {}
        self.bytes_of: dict[str, str] = {}
        self.lone: dict[str, int] = {}

    # what the library does with single code points, asked once each

    def kind(self, char: str) -> str:
        """L: letter, N: digit, S: white space, O: any other."""
        found = self.kinds.get(char)
        if found is None:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            found = "S" if not cut(char) else "L" if len(cut("a" + char)) == 1 else "O" if len(cut("!" + char)) == 1 else "N"
            self.kinds[char] = found
        return found

    def symbols(self, char: str) -> str:
        """The byte symbols of a code point."""
        found = self.bytes_of.get(char)
        if found is None:
            found = self.bytes_of[char] = "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(char))
        return found

    def alone(self, word: str) -> int:
        """Count of one word."""
        if word not in self.lone:
            held = Word(self.merges)
            held.push("".join(map(self.symbols, word)))
            self.lone[word] = held.ended()
        return self.lone[word]

    def _normal(self, raw: str) -> str:
        return self.tokenizer.normalizer.normalize_str(raw)

    def learn_plain(self, words: set[str]) -> None:
        """Keeps the steps of words of lower-case Latin letters, or of marks.  In
        order, so that what a word shares with the one before it is not done again."""
        tokens, known, follows = self.merges.tokens, self.merges.known, self.merges.follows
        sizes, sizes_of, symbols = self.merges.sizes, self.merges.sizes_of, self.symbols
        text, counts, last = "", [0], [""]  # by symbol
        ends, steps, count = [0], [0], [0]  # by letter: symbols up to it, step to its count, its count
        before = ""
        for word in sorted(words):
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            text = text[: ends[same]]
            del counts[len(text) + 1 :], last[len(text) + 1 :], ends[same + 1 :], steps[same + 1 :], count[same + 1 :]
            for letter in word[same:]:
                for symbol in symbols(letter):
                    text += symbol
                    end = len(text)
                    inner = final = 0
                    tail = text[-TAIL:]
                    # the longest tokens that end here come first; one can go on, one can end the word
                    for size in sizes.get(tail) or sizes_of(tail):
                        at = end - size
                        found = tokens.get(text[at:]) if at >= 0 else None
                        if found is None:
                            continue
                        go_on, stop = found
                        if not inner and go_on:
                            fits = known.get((last[at], go_on))
                            if follows(last[at], go_on) if fits is None else fits:
                                inner, token = counts[at] + 1, go_on
                        if not final and stop:
                            fits = known.get((last[at], stop))
                            if follows(last[at], stop) if fits is None else fits:
                                final = counts[at] + 1
                        if inner and final:
                            break
                    counts.append(inner)
                    last.append(token)
                ends.append(end)
                steps.append(final - count[-1])
                count.append(final)
            before = word
            self.plain[word] = array("i", steps[1:]).tobytes()

    def _read(self, reader: Reader, raw: str) -> Iterator[int]:
        """Counts after each code point of a text without special tokens."""
        at = 0
        while at < len(raw):
            end = at + 1
            while end < len(raw) and _may_combine(raw[end]):
                end += 1
            if reader.word:
                reader.word.trim()
            start = reader.copy() if end - at > 1 else None
            for k in range(at + 1, end + 1):
                if start is not None and k > at + 1:
                    reader.restore(start)
                for char in self._normal(raw[at:k]):
                    reader.feed(char)
                yield reader.count()
            at = end

    def counts(self, chunk: str) -> np.ndarray:
        """Counts of the prefixes of a text without blanks, from 1 code point on."""
        out, at, base = [], 0, 0
        for special in self.specials.finditer(chunk):
            reader = Reader(self, base)
            out.extend(self._read(reader, chunk[at : special.start()]))
            before = out[-1] if out else 0
            out.extend(self._read(reader, special.group()[:-1]))
            at, base = special.end(), before + 1
            out.append(base)
        out.extend(self._read(Reader(self, base), chunk[at:]))
        return np.array(out, dtype=np.int64)

    def steps(self, text: str) -> np.ndarray:
        """Differences of the counts of all prefixes of a text, in order."""
        if len(self.known) > KEPT_WORDS or len(self.plain) > KEPT_WORDS:
            self.known.clear()
            self.plain.clear()
        known, pieces = self.known, _PIECES.findall(text)
        large: dict[str, bytes] = {}
        simple: dict[str, tuple[int, str, str]] = {}
        for piece in set(pieces).difference(known):
            found = _PLAIN.fullmatch(piece)
            if found and not self.specials.search(piece):
                simple[piece] = len(found[1]), found[2].lower(), found[3]
                continue
            word = piece.lstrip(" \t\r\n")
            counts = self.counts(word) if word else np.zeros(0, dtype=np.int64)
            steps = bytes(4 * (len(piece) - len(word))) + np.diff(counts, prepend=0).astype("<i4").tobytes()
            (known if len(piece) <= KEPT_LENGTH else large)[piece] = steps
        self.learn_plain({x for _, *both in simple.values() for x in both if x}.difference(self.plain))
        plain = self.plain
        for piece, (blanks, word, marks) in simple.items():
            known[piece] = bytes(4 * blanks) + plain[word] + (plain[marks] if marks else b"")
        found = [known.get(x) or large[x] for x in pieces] if large else list(map(known.__getitem__, pieces))
        return np.frombuffer(b"".join(found), dtype="<i4")

    def prefix_counts(self, texts: list[str], block: int = BLOCK_CHARS) -> Iterator[tuple[int, np.ndarray]]:
        """(text number, its next ``counts``) for the texts in order, the first
        code point's first: a long text comes in pieces, an empty one not."""
        waiting: list[int] = []
        size = 0

        def settle() -> Iterator[tuple[int, np.ndarray]]:
            # a blank between two texts changes neither's counts
            steps, at = self.steps("\n".join([texts[i] for i in waiting])), 0
            for i in waiting:
                yield i, np.cumsum(steps[at : at + len(texts[i])], dtype=np.int64)
                at += len(texts[i]) + 1
            waiting.clear()

        for i, text in enumerate(texts):
            if len(text) > block:
                yield from settle()
                size = start = base = 0
                while start < len(text):
                    cut = _CUT.search(text, start + block)
                    end = cut.start() if cut else len(text)
                    counts = base + np.cumsum(self.steps(text[start:end]), dtype=np.int64)
                    yield i, counts
                    start, base = end, int(counts[-1])
            elif text:
                waiting.append(i)
                size += len(text)
                if size > block:
                    yield from settle()
                    size = 0
        yield from settle()


def _may_combine(char: str) -> bool:
    """Whether composition may join a code point to the one before it."""
    return char > "˿" and (unicodedata.category(char)[0] == "M" or "ᅠ" <= char <= "ᇿ")


def _counter(path: str) -> PrefixCounter:
    cache = worker_cache()
    if path not in cache:
        cache.clear()
        cache[path] = PrefixCounter(path)
    return cache[path]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def count_tokens(docs: DataFrame, limit: int = LIMIT, vocabulary: str | None = None, block: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars): the count of the
    whole text, and the code points of its longest prefix with at most
    ``limit`` tokens."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens, fitting, seen = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for i, counts in counter.prefix_counts(texts, block):
                within = np.flatnonzero(counts <= limit)
                if len(within):
                    fitting[i] = seen[i] + within[-1] + 1
                tokens[i] = counts[-1]
                seen[i] += len(counts)
            size = np.array([len(x.encode()) for x in texts], dtype=np.int64)
            columns = [batch.column(0), size, tokens, tokens > limit, fitting]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], schema=OUT)


    return _rows(docs).mapInArrow(run, OUT_DDL)


def prefix_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, counts): ``counts[i]`` tokens in the first ``i`` code points."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = np.concatenate([np.zeros(1, dtype=np.int64), *(x for _, x in counter.prefix_counts([value.as_py() or ""]))])
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([counts.astype(np.int32)], pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return _rows(docs).mapInArrow(run, "doc_id long, counts array<int>")


def tokens_of_prefix(counts: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points (of the whole text, if shorter)."""
    return F.element_at(counts, F.least(chars + 1, F.size(counts)).cast("int"))


def longest_prefix(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    return F.array_max(F.transform(counts, lambda c, i: F.when(c <= budget, i).otherwise(F.lit(0))))
