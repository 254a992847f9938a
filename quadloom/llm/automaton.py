"""Byte-pair encoding as an automaton over tokens.

The merges are compiled one after the other, each by a gadget.  The first state
has an arc for every base symbol.  A merge ``a b`` redirects all arcs ``a`` to a
copy of their target that lacks the arc ``b``, and every state with an arc
``a`` gets an arc ``ab`` to where the path ``a b`` led.  All arcs with one label
keep one common target, so a token determines the state that follows it, and a
token sequence is what the merges yield exactly when it is a path.

A gadget is stored as what it changes.  The states behind the label ``a`` are
numbered by the times of the merges that begin with ``a``; each lacks one more
label than the one before, and the first of them is the state behind the right
part of ``a`` at the time when ``a`` was made.  An arc ``ab`` is present in a
state where ``a`` was present at the time of ``ab``.  So the tables have one
entry per merge, and looking up an arc walks down the parts of two labels.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Words whose ids are kept, and their bytes; beyond either all are forgotten. Results do not depend on it.
CACHE, CACHE_BYTES = 300_000, 32 << 20
AT_ONCE = 1 << 20  # characters of texts that are split together
PAIRS = 500_000  # pairs of labels that are kept
LONG = 64  # bytes; longer words are taken one by one
_FINAL = 256  # symbols: a byte within a word, or a byte that ends the word plus this
# words of lower-case ASCII between white space, as the tokenizer's own pattern splits it
_ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 \t\n\r\x0b\x0c]+")
# the same for ASCII and those Latin-1 letters that normalizing leaves alone
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ \t\n\r\x0b\x0c]+")
_LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t\n\r\x0b\x0c]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Table:
    """Integers by non-negative integer keys, looked up for whole arrays at once (open addressing)."""

    def __init__(self, bits: int):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and new; the table grows before it is half full."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            there = self.keys >= 0
            grown = Table(max(self.bits + 1, int(4 * (self.used + len(keys))).bit_length()))
            grown.put(self.keys[there], self.values[there])
            self.__dict__.update(grown.__dict__)
        self.used += len(keys)
        at, last = self._slots(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for one slot one stays
            done = self.keys[at] == keys
            self.values[at[done]] = values[done]
            keys, values, at = keys[~done], values[~done], (at[~done] + 1) & last

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(len(keys), missing, np.int32)
        at, last = self._slots(keys), len(self.keys) - 1
        there = self.keys[at]
        hit = there == keys
        out[hit] = self.values[at[hit]]
        left = np.flatnonzero(~hit & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & last
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class Automaton:
    """Encodes and decodes as the ``tokenizers`` library does with the same file.

    The file must hold byte-level BPE with an end-of-word suffix.  Texts: null
    counts as empty; the strings of special tokens in a text become their ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["dropout"]:
            raise ValueError("a byte-level BPE with an end-of-word suffix is needed")
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.labels = [b""] * (max([*model["vocab"].values(), *self.special.values()]) + 1)
        for token, i in (model["vocab"] | self.special).items():
            self.labels[i] = token.encode()
        self._compile(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.pairs: dict[int, bool] = {}
        self._forget()

    def _compile(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        n = len(self.labels)
        self.made = [-1] * n  # when the label appeared; -1: a base symbol
        self.left, self.right = [-1] * n, [-1] * n
        self.gadgets: dict[int, int] = {}  # a and b: when the arcs a were led to a state without b
        spelt = {vocab[c]: chr(b) for b, c in enumerate(letters) if c in vocab}
        spelt |= {vocab[c + suffix]: chr(b + _FINAL) for b, c in enumerate(letters) if c + suffix in vocab}
        for time, pair in enumerate(merges):
            x, y = pair.split(" ") if isinstance(pair, str) else pair
            a, b, ab = vocab[x], vocab[y], vocab[x + y]
            if self._arc(a, b):
                self.made[ab], self.left[ab], self.right[ab] = time, a, b
                self.gadgets[a << 32 | b] = time
                spelt[ab] = spelt[a] + spelt[b]
        self.token = {s: i for i, s in spelt.items()}
        self.size = [len(spelt.get(i, "")) for i in range(n)]
        # the shorter tokens that begin each token, longest first
        self.start = [-1] * n
        self.prefix: dict[str, int] = {}  # for all that a token begins with: the longest token it begins with
        for s in sorted(self.token, key=len):
            best = -1
            for k in range(1, len(s)):
                best = self.prefix.setdefault(s[:k], self.token.get(s[:k], best))
            i = self.prefix[s] = self.token[s]
            self.start[i] = best
        # the prefixes as numbered nodes: a node and a symbol give the next node, a node its longest token
        node = {p: k + 1 for k, p in enumerate(self.prefix)} | {"": 0}
        self.child, self.known = Table(18), Table(18)
        keys = [node[p[:-1]] << 10 | ord(p[-1]) for p in self.prefix]
        self.child.put(np.array(keys, np.int64), np.array([node[p] for p in self.prefix], np.int32))
        self.best = np.array([-1, *self.prefix.values()], np.int64)
        self.sizes, self.starts = np.array(self.size, np.int64), np.array(self.start, np.int64)

    def _arc(self, a: int, label: int) -> bool:
        """Whether the state behind the label ``a`` has an arc with this label."""
        made, gadgets, now = self.made, self.gadgets, len(self.made)
        while True:
            lost = gadgets.get(a << 32 | label)
            if lost is not None and lost < now:
                return False
            if made[a] >= 0 and made[a] >= made[label]:
                now = min(now, made[a])
                a = self.right[a]
            elif made[label] >= 0:
                now = min(now, made[label] + 1)
                label = self.left[label]
            else:
                return True

    def path(self, symbols: str) -> list[int]:
        """The path that spells a word: the longest arc first, shorter ones when it leads nowhere."""
        prefix, size, start, pairs, n = self.prefix.get, self.size, self.start, self.pairs, len(symbols)
        dead, found, at, last, label = set(), [], 0, -1, -2
        while at < n:
            if label == -2:
                label, end = prefix(symbols[at]), at + 2
                while end <= n and (longer := prefix(symbols[at:end])) is not None:
                    label = longer
                    end += 1
            while label >= 0:
                if at + size[label] not in dead:
                    if last < 0:
                        break
                    key = last << 32 | label
                    follows = pairs.get(key)
                    if follows is None:
                        if len(pairs) >= CACHE:
                            pairs.clear()
                        follows = pairs[key] = self._arc(last, label)
                    if follows:
                        break
                label = start[label]
            if label >= 0:
                found.append(label)
                at += size[label]
                last, label = label, -2
            else:
                dead.add(at)
                label = found.pop()
                at -= size[label]
                last, label = found[-1] if found else -1, start[label]
        return found

    def paths(self, words: list[bytes]) -> list[bytes]:
        """``path`` for many words at once, as ids; long words go one by one."""
        lengths = np.array(list(map(len, words)), np.int64)
        ends = np.cumsum(lengths)
        symbols = np.zeros(int(ends[-1]) + 1, np.int64)
        symbols[:-1] = np.frombuffer(b"".join(words), np.uint8)
        symbols[ends - 1] += _FINAL
        out = np.full(len(symbols), -1, np.int64)  # a label where it begins
        row, alone = np.flatnonzero(lengths <= LONG), np.flatnonzero(lengths > LONG)
        dead = np.zeros(len(symbols) + 1, bool)
        came = np.zeros(len(symbols) + 1, np.int64)  # where the arc to a place begins
        before = np.full(len(symbols) + 1, -1, np.int64)  # and its label
        at, label = (ends - lengths)[row], np.full(len(row), -2)
        while len(row):
            fresh = np.flatnonzero(label == -2)
            if len(fresh):
                label[fresh] = self._longest(symbols, at[fresh])
            while len(back := np.flatnonzero(label == -1)):  # no arc is left here: give up the one before
                dead[at[back]] = True
                at[back] = came[at[back]]
                label[back] = self.starts[out[at[back]]]
                out[at[back]] = -1
            last, to = before[at], at + self.sizes[label]
            ok = ~dead[to]
            some = np.flatnonzero(ok & (last >= 0))
            ok[some] = self._known(last[some] << 32 | label[some])
            done = np.flatnonzero(ok)
            out[at[done]] = before[to[done]] = label[done]
            came[to[done]] = at[done]
            at[done] = to[done]
            label = np.where(ok, -2, self.starts[label])
            on = at < ends[row]
            row, at, label = row[on], at[on], label[on]
        set_ = out >= 0
        upto = np.cumsum(set_)
        flat = out[set_].astype("<u4").tobytes()
        stop = (4 * upto[ends - 1]).tolist()
        begin = [0, *stop[:-1]]
        found = [flat[i:j] for i, j in zip(begin, stop)]
        for k in alone.tolist():
            w = words[k]
            found[k] = array("I", self.path(w[:-1].decode("latin-1") + chr(w[-1] + _FINAL))).tobytes()
        return found

    def _longest(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest label that the symbols at each place begin with; none goes on beyond a word's end."""
        node = np.zeros(len(at), np.int64)
        active, step = np.arange(len(at)), at.copy()
        while len(active):
            to = self.child.get(node[active] << 10 | symbols[step[active]], -1)
            active, to = active[to >= 0], to[to >= 0]
            node[active] = to
            step[active] += 1
            active = active[step[active] < len(symbols)]
        return self.best[node]

    def _known(self, pairs: np.ndarray) -> np.ndarray:
        """``_arc`` for packed pairs of labels."""
        found = self.known.get(pairs, -1)
        if len(new := np.unique(pairs[found < 0])):
            if self.known.used > PAIRS:
                self.known = Table(18)
            answers = [self._arc(p >> 32, p & 0xFFFFFFFF) for p in new.tolist()]
            self.known.put(new, np.array(answers, np.int32))
            missing = np.flatnonzero(found < 0)
            found[missing] = np.array(answers, np.int32)[np.searchsorted(new, pairs[missing])]
        return found == 1

    def _forget(self) -> None:
        """Empty the cache: the number of each word, and where its ids are in one flat array."""
        self.index: dict[bytes | str, int] = {}
        self.ends = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.held = 0

    def _words(self, text: str) -> list[bytes | str]:
        """A text's words, lower case in UTF-8, or as strings where that saves encoding them."""
        if text.isascii():
            return _ASCII.findall(text.encode().lower())
        if _LATIN.fullmatch(text):
            return _LATIN_WORDS.findall(text.lower())
        words: list[bytes | str] = []
        for chunk in text.encode().split():
            if chunk.isascii():
                words += _ASCII.findall(chunk.lower())
            elif _LATIN.fullmatch(piece := chunk.decode()):
                words += _LATIN_WORDS.findall(piece.lower())
            else:
                words += [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.split(self.normalize(piece))]
        return words

    def _learn(self, new: list[bytes | str]) -> None:
        """Put the ids of these words into the cache."""
        raw = [w if isinstance(w, bytes) else w.encode() for w in new]
        ids = self.paths(raw)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        self.held += sum(map(len, raw))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` for some texts; the words of about ``AT_ONCE`` characters are looked up together."""
        out: list[bytes] = []
        group: list[str | None] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= AT_ONCE:
                out += self._encoded(group)
                group, size = [], 0
        return out + self._encoded(group)

    def _encoded(self, texts: list[str | None]) -> list[bytes]:
        words: list[bytes | str] = []
        rows, ends = [], [0]  # for each text its runs of words and special ids in order; where each run ends
        for text in texts:
            row: list[int | bytes] = []
            at = 0
            if text and "<" in text:
                for m in self.special_at.finditer(text):
                    row += [len(ends), array("I", [self.special[m[0]]]).tobytes()]
                    words += self._words(text[at : m.start()])
                    ends.append(len(words))
                    at = m.end()
            if text:
                row.append(len(ends))
                words += self._words(text[at:] if at else text)
                ends.append(len(words))
            rows.append(row)
        if len(self.index) > CACHE or self.held > CACHE_BYTES:
            self._forget()
        if new := set(words).difference(self.index):
            self._learn(list(new))
        k = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        first = self.ends[k]
        lengths = self.ends[k + 1] - first
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.arange(upto[-1]) + np.repeat(first - upto[:-1], lengths)].astype("<u4").tobytes()
        stops = (4 * upto[ends]).tolist()
        runs = [b"", *[ids[i:j] for i, j in zip(stops, stops[1:])]]
        return [runs[row[0]] if len(row) == 1 else b"".join([x if isinstance(x, bytes) else runs[x] for x in row]) for row in rows]

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs in UTF-8, as the library decodes without a decoder of its own."""
        return b" ".join(map(self.labels.__getitem__, memoryview(ids).cast("I").tolist()))


def automaton(path: str) -> Automaton:
    """One automaton per Python worker and file."""
    return _compiled(path)


@lru_cache(maxsize=2)
def _compiled(path: str) -> Automaton:
    return Automaton(path)


