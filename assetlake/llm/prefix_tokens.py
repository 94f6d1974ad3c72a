"""Token counts of every prefix of a text, for a byte-level BPE tokenizer with word ends.

``prefix_tokens`` stores, for each code point, how many tokens the text up to there has - exactly
as the tokenizer library counts that prefix - so questions of length, truncation and budget are
answered from the array (``tokens_of_first``, ``longest_prefix``, ``fits``) without encoding again.

The counts come from dynamic programming.  A text is a row of words (the tokenizer's
pre-tokens); a prefix has the tokens of the words before the one it ends in, plus those of the
started word.  Inside a word, a token sequence is the tokenizer's own exactly if each token and
each pair of neighbours is what the merge rules make of its characters; so the last token of each
prefix is the one suffix that fits the last token of what precedes it, and its count is one more.
States are kept by prefix, so words that begin alike share them.

Edge cases: null and empty texts have an empty array and no tokens; strings of added tokens count
one token once they are complete, and as ordinary text while they are not; texts beyond plain
Latin letters are normalised by the library piece by piece, between blanks; nothing is truncated
or capped.  Other columns are ignored.  Every row is handled by itself, so ties and repeats change
nothing.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import blocks

END = "</w>"
KEPT_STATES, KEPT_WORDS, KEPT_PAIRS = 1 << 19, 3 << 18, 1 << 18
SIMPLE = regex.compile(r"[\x00-įı-ɏ]*+")  # NFC keeps these, lower case is one to one
BLANKS = regex.compile(r"\p{White_Space}+")


# of the letters of a started word: tokens and last token, tokens if the word ends here, and where the
# longest of its ends starts that begins a token
State = tuple[int, str, int, int]
FIRST_STATE: State = (0, "", 0, 0)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if it is one, else the next letter from U+0100."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(printable)]
    return [chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)]


class PrefixCounter:
    """Counts tokens of all prefixes; made once per task from the tokenizer's file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = content["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        names = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(names)}
        # the merge that makes a token: its rank and its two parts; each token has one at most
        self.made: dict[str, tuple[int, str, str]] = {}
        for rank, (left, right) in enumerate(names):
            self.made.setdefault(left + right, (rank, left, right))
        if len(self.made) != len(names):
            raise ValueError("tokens with two merges are not handled")
        # the letters of the tokens that end words, and all beginnings of tokens
        self.closed = {t[: -len(END)]: t for t in self.vocabulary if t.endswith(END)}
        self.beginnings = {t[:n] for t in [*self.vocabulary, *self.closed] for n in range(len(t) + 1)}
        self.letters = byte_letters()
        pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(pattern)
        self.pieces = regex.compile(f"({pattern})")
        added = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.states: dict[str, State] = {"": FIRST_STATE}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = _Steps(self)

    def merged(self, symbols: list[str]) -> list[str]:
        """Applies the merge rules: always the first of the best-ranked pairs."""
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 30:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(END):
            return [*token[: -len(END) - 1], token[-len(END) - 1 :]]
        return list(token)

    def fits(self, left: str, right: str) -> bool:
        """Whether the rules leave the two tokens (or, with an empty left, the one) as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if left:
                known = self.fits("", right) and self._apart(left, right)
            else:
                known = self.merged(self._symbols(right)) == [right]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def _apart(self, left: str, right: str) -> bool:
        """Whether no merge across the border of two tokens comes before those that build them.

        Takes the merges back, the latest first.  The pieces at the border then stood side by side
        until the merge taken back last; a merge of the two before that would have joined them.
        Of equal ranks the one further left comes first: before the border the token's own, behind
        it the joining one.
        """
        ranks, made = self.ranks, self.made
        until = len(ranks)
        while True:
            if ranks.get((left, right), until) < until:
                return False
            from_left, from_right = made.get(left), made.get(right)
            if from_left and (not from_right or from_left[0] > from_right[0]):
                until, left = from_left[0], from_left[2]
            elif from_right:
                until, right = from_right[0] + 1, from_right[1]
            else:
                return True

    def _state(self, word: str) -> State:
        """The state after the letters ``word``; its shorter prefixes are known.

        A token that ends here starts where the longest end that begins a token starts, or later, and
        that place never goes back as letters are added.
        """
        vocabulary, closed, states, pairs = self.vocabulary, self.closed, self.states, self.pairs
        start, beginnings = states[word[:-1]][3], self.beginnings
        while word[start:] not in beginnings:
            start += 1
        reach, tokens, last, ended = start, 0, "", 0
        for start in range(reach, len(word)):
            token = word[start:]
            if not tokens and token in vocabulary:
                count, left, _, _ = states[word[:start]]
                known = pairs.get((left, token))
                if self.fits(left, token) if known is None else known:
                    tokens, last = count + 1, token
            if not ended and token in closed:
                token = closed[token]
                count, left, _, _ = states[word[:start]]
                known = pairs.get((left, token))
                if self.fits(left, token) if known is None else known:
                    ended = count + 1
            if tokens and ended:
                return tokens, last, ended, reach
        raise ValueError(f"no token ends {word!r}")

    def in_word(self, word: str) -> list[int]:
        """Tokens of each prefix (by code points) of one pre-token."""
        if len(self.states) >= KEPT_STATES:
            self.states = {"": FIRST_STATE}
        states, letters = self.states, self.letters
        if word.isascii():
            spelt, ends = "".join([letters[ord(c)] for c in word]), range(1, len(word) + 1)
        else:
            encoded = [c.encode("utf-8", "surrogatepass") for c in word]
            spelt = "".join([letters[byte] for c in encoded for byte in c])
            ends = accumulate(map(len, encoded))
        counts, at = [], 0
        for end in ends:
            for n in range(at + 1, end + 1):
                prefix = spelt[:n]
                state = states.get(prefix)
                if state is None:
                    state = states[prefix] = self._state(prefix)
            counts.append(state[2])
            at = end
        return counts

    def steps(self, piece: str) -> bytes:
        """The changes of the count along a pre-token, or the blanks between two, as 16-bit integers."""
        if not piece or BLANKS.match(piece):
            return bytes(2 * len(piece))
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # 's and the like are one word only when whole
            counts = [self.in_word("'")[0], *(1 + n for n in self.in_word(piece[1:-1])), self.in_word(piece)[-1]]
        else:
            counts = self.in_word(piece)
        return array("h", [n - before for before, n in zip([0, *counts], counts, strict=False)]).tobytes()

    def _count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False))

    def _plain(self, text: str) -> list[bytes]:
        """Steps of a text without added tokens."""
        found: list[bytes] = []
        if SIMPLE.fullmatch(text):
            return [*map(self.words.__getitem__, self.pieces.split(text.lower()))]
        for piece in regex.splititer(r"(\p{White_Space}+)", text):
            if not piece or BLANKS.fullmatch(piece):
                found.append(bytes(2 * len(piece)))
            elif SIMPLE.fullmatch(piece):
                found += self._plain(piece)
            else:
                found.append(self._foreign(piece))
        return found

    def _foreign(self, piece: str) -> bytes:
        """Steps of a piece between blanks that the library normalises.

        Its pre-tokens are found with the library.  Where a prefix ends inside one, and the
        letters before are unchanged by what follows, the states of that pre-token answer it.
        """
        normal = self.library.normalizer.normalize_str(piece)
        one_to_one = len(normal) == len(piece) and all(
            self.library.normalizer.normalize_str(c) == n for c, n in zip(piece, normal, strict=True)
        )
        if one_to_one:
            counts, base, at = [], 0, 0
            for match in self.word.finditer(normal):
                counts += [base] * (match.start() - at)
                inside = np.cumsum(np.frombuffer(self.words[match[0]], np.int16))
                counts += (base + inside).tolist()
                base, at = base + int(inside[-1]), match.end()
            counts += [base] * (len(piece) - at)
        else:
            counts = [self._count(piece[: i + 1]) for i in range(len(piece))]
        return np.diff(np.array([0, *counts])).astype(np.int16).tobytes()

    def prefixes(self, text: str | None) -> np.ndarray:
        """Tokens of the first 1, 2, ... code points of a text."""
        if not text:
            return np.empty(0, np.int32)
        parts, at = [], 0
        for match in self.added.finditer(text) if self.added else ():
            parts += self._plain(text[at : match.start()])
            before = np.frombuffer(b"".join(parts), np.int16).sum(dtype=np.int64)
            # while the added token is incomplete it joins the signs before it
            start = match.start()
            while start > at and not BLANKS.match(text[start - 1]):
                start -= 1
            known = before - self._count(text[start : match.start()])
            inside = [known + self._count(text[start:p]) for p in range(match.start() + 1, match.end())]
            parts.append(np.diff(np.array([before, *inside, before + 1])).astype(np.int16).tobytes())
            at = match.end()
        parts += self._plain(text[at:])
        return np.cumsum(np.frombuffer(b"".join(parts), np.int16), dtype=np.int32)


class _Steps(dict):
    """Steps of pieces already met."""

    def __init__(self, owner: PrefixCounter):
        super().__init__()
        self.owner = owner

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[piece] = self.owner.steps(piece)
        return found


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process, kept between tasks; its memory is bounded by the KEPT numbers."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and prefix_tokens (array of int, one per code point) of every row of ``docs``."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in blocks(batches, "text"):
            arrays = [known.prefixes(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
            values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), column], ["doc_id", "n_bytes", "prefix_tokens"])

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select("doc_id", n_bytes, "text").mapInArrow(count, "doc_id long, n_bytes long, prefix_tokens array<int>")


def n_tokens(prefixes: Column | str) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at(prefixes, F.lit(-1)), F.lit(0)).cast("long")


def tokens_of_first(prefixes: Column | str, n_chars: int) -> Column:
    """Tokens of the first ``n_chars`` code points."""
    at = F.least(F.lit(n_chars), F.size(prefixes))
    return F.when(at > 0, F.try_element_at(prefixes, F.greatest(at, F.lit(1)))).otherwise(0).cast("long")


def longest_prefix(prefixes: Column | str, budget: int) -> Column:
    """The most code points whose tokens are within ``budget``."""
    within = F.transform(prefixes, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(within), F.lit(0)).cast("long")


def truncated(text: Column | str, prefixes: Column | str, budget: int) -> Column:
    """The text cut to its longest prefix within ``budget`` tokens."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substr(text, F.lit(1), longest_prefix(prefixes, budget).cast("int"))
