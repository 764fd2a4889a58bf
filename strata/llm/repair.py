"""Token-id files compressed by Re-Pair grammars, with random access.

Documents are tokenised in ascending id order and dealt into shards of bounded
size. Within a shard the most frequent pair of neighbouring symbols becomes a
nonterminal, again and again, until no pair repeats. A file
stores the rules, the expansion length of every nonterminal, the remaining
symbols with a position every ``_MARK`` symbols, and the documents' ids and
lengths, so that any range of ids is decoded without the rest
(:meth:`Shard.read`).

A task writes its files under names of its own; readers learn names only from
rows of tasks that succeeded. Documents of one bucket of ids form one task, in
order; a bucket beyond ``MAX_SHARD_IDS`` ids spans several files, so a worker
holds ``SHARDS_TOGETHER`` shards, whatever the bucket.

Defined cases: null and empty texts have the end id only; a null doc_id comes
first; rows repeating an id are ordered by their text and each is a document;
texts of any length are whole (a document never spans files); an empty table
writes nothing. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import kept
from strata.llm.files import create, open_file
from strata.sinks.writer import stage

END_ID = 0
MAX_SHARD_IDS = 1 << 19  # a grammar's arrays stay in the processor's caches
# Documents of a bucket: some 1.4 million ids of ordinary prose. A bucket is one task, which writes as many files as its ids need.
ROWS_PER_BUCKET, MAX_BUCKETS, MAX_READERS = 1_024, 20_000, 4_096
SHARDS_TOGETHER, FILES_PER_READER = 2, 8  # a worker holds so many shards at a time, or one file
MIN_COUNT = 2  # a pair that occurs so often gets a rule: every pair that repeats
_LOW = 32  # counts up to this are gone through one by one by all shards together
_MAGIC, _HEAD, _MARK = b"RPG2", "<4sIIIIQQ", 1024
_MOST_PIECES, _MOST_WORDS = 100_000, 1_800_000  # some 400 MB a worker
_WORDS_AT_ONCE, _CHARS_AT_ONCE = 8_192, 4 << 20
# Letters and digits of the alphabet below; the pattern that splits text before its merges (fixed value).
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_GAP = re.compile(r"[\t\n\r ]{2}")
# Characters that Python's expressions and the tokenizer's class alike; a text with any other goes to the library whole.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞]")


def byte_bpe_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from 256 on (a rule of the format)."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


class _Memo(dict):
    """Ids of the strings met, the first ``most`` of them remembered (frequent ones come early)."""

    def __init__(self, ids_of, most: int):
        self.ids_of, self.most = ids_of, most

    def __missing__(self, part: str) -> bytes:
        ids = self.ids_of(part)
        if len(self) < self.most:
            self[part] = ids
        return ids


class Encoder:
    """Ids of texts by a tokenizer file of byte-level BPE; words met before are looked up.

    The merges never cross the pieces of the tokenizer's split, and where no two
    white spaces touch no piece crosses a space or a line's end, so a text's ids are
    those of its words. Other texts are split by the pattern, and texts beyond
    its alphabet (or files with another split) go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, models

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.by_piece = (split.get("type"), split.get("use_regex", True), split.get("add_prefix_space")) == ("ByteLevel", True, False) \
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and len(self._whole("\n")) == 4
        model = spec["model"]
        self.model = None
        if self.by_piece and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self.model = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)  # the cache is ours
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.pieces = _Memo(self._piece, _MOST_PIECES)
        # a word's key leaves out the space before it; after a line's end it has that in front
        self.words = _Memo(self._word, _MOST_WORDS)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.model is None:
            return self._whole(piece)
        ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTE_LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._piece(" " + word)
        return self._split(word if word[:1] == "\n" else " " + word)

    def _split(self, text: str) -> bytes:
        pieces, words = self.pieces, self.words
        return b"".join([words[p[1:]] if p[0] == " " and p[1:].isalpha() else pieces[p] for p in _SPLIT.findall(text)])

    def _alphabetic(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words of letters, put into the model's alphabet many at a time."""
        if self.model is None:
            return {w: self._piece(" " + w) for w in words}
        out = {}
        for k in range(0, len(words), _WORDS_AT_ONCE):
            some = words[k:k + _WORDS_AT_ONCE]
            letters = (" " + "\n ".join(some)).encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids, ends = [], []
            for tokens in map(self.model.tokenize, letters.split(_BYTE_LETTERS[10])):
                ids += [t.id for t in tokens]
                ends.append(4 * len(ids))
            data = np.array(ids, "<u4").tobytes()
            out.update((w, data[a:b]) for w, a, b in zip(some, [0, *ends], ends))
        return out

    def _each_word(self, words: list[str]) -> list[bytes]:
        """Ids of the distinct ``words``, as :meth:`_word` gives them."""
        known = self.words
        got = list(map(known.get, words))
        new = [w for w, ids in zip(words, got, strict=True) if ids is None]
        if not new:
            return got
        letters = {w: None for w in new if w.isalpha()}
        split = {w: _SPLIT.findall(w if w[:1] == "\n" else " " + w) for w in new if w not in letters}
        letters.update((p[1:], None) for parts in split.values() for p in parts if p[0] == " " and p[1:].isalpha() and p[1:] not in known)
        fresh, pieces = self._alphabetic(list(letters)), self.pieces
        fresh |= {w: b"".join([(known.get(p[1:]) or fresh[p[1:]]) if p[0] == " " and p[1:].isalpha() else pieces[p] for p in parts]) for w, parts in split.items()}
        room = known.most - len(known)
        known.update(fresh if len(fresh) <= room else dict(list(fresh.items())[:max(0, room)]))
        return [fresh[w] if ids is None else ids for w, ids in zip(words, got, strict=True)]

    def _lines(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts without white spaces that touch: those of their distinct words, put in their places."""
        words = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n"), " ")
        at, coded = words.offsets.to_numpy(), words.values.dictionary_encode()
        found = self._each_word(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary), " ")[0].as_py().split(" "))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        codes = coded.indices.to_numpy()
        size = lengths[codes]
        size[at[:-1]] = 0  # what is before a line's first space
        ends = np.cumsum(size)
        place = (np.cumsum(lengths) - lengths)[codes] - (ends - size)
        out = np.frombuffer(b"".join(found), "<u4")[np.arange(ends[-1]) + np.repeat(place, size)].tobytes()
        bounds = (4 * np.append(0, ends)[at]).tolist()
        return [out[a + 4:b] for a, b in zip(bounds, bounds[1:])]  # without the line's end put in front

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What :meth:`encode` gives for each of the texts (null: empty); a few MB of them at a time."""
        texts = texts.fill_null("")
        sizes = pc.binary_length(texts).to_numpy()
        step = np.cumsum(sizes) // _CHARS_AT_ONCE
        for some in np.split(np.arange(len(texts)), np.flatnonzero(step[1:] != step[:-1]) + 1):
            part = texts.slice(some[0], len(some)) if len(some) else texts
            text = part.to_pylist()
            plain = np.zeros(len(text), bool)
            if self.by_piece:
                gap = pc.match_substring_regex(pc.binary_join_element_wise("\n", part, ""), "[\\t\\n\\r ]{2}").to_numpy(zero_copy_only=False)
                plain = ~gap & (sizes[some] > 0) & (sizes[some] <= _CHARS_AT_ONCE)
                plain &= np.fromiter((not p or not (_OTHER.search(t) or any(a in t for a in self.added)) for p, t in zip(plain, text)), bool, len(text))
            done = iter(self._lines(part.filter(pa.array(plain))) if plain.any() else ())
            for p, t in zip(plain.tolist(), text, strict=True):
                yield next(done) if p else self.encode(t)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not self.by_piece or _OTHER.search(text) or any(a in text for a in self.added):
            return self._whole(text)
        line = "\n" + text
        if not text or _GAP.search(line):
            return self._split(text)
        return b"".join(map(self.words.__getitem__, line.replace("\n", " \n").split(" ")[1:]))[4:]


# ------------------------------------------------------------------ grammar
def _independent(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Which of 0..n-1 to take so that no edge (u, v) joins two of them and none could be added; ranks are shuffled, so passes are few."""
    rank = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
    state = np.zeros(n, np.int8)  # 1: taken, -1: next to one that is
    while len(u):
        beaten = np.zeros(n, bool)
        beaten[np.where(rank[u] > rank[v], u, v)] = True
        taken = (state == 0) & ~beaten
        state[taken] = 1
        state[v[taken[u]]] = -1
        state[u[taken[v]]] = -1
        still = (state[u] == 0) & (state[v] == 0)
        u, v = u[still], v[still]
    return state >= 0


def compress_together(shards: list[np.ndarray], min_count: int = MIN_COUNT, per_round: int | None = None,
                      max_rounds: int | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each shard (symbols, rules, first nonterminal): rule k says which two symbols nonterminal ``first + k`` stands for.

    Re-Pair: the pair of neighbours that occurs most often (overlaps counted once) becomes
    a nonterminal wherever it occurs, counts are brought up to date, and so on until no pair
    occurs ``min_count`` times. Pairs that occur equally often and share no symbol in
    the sequence are replaced together, which is one of the orders of replacing them in turn:
    neither changes the other's count, and a pair that a replacement makes is no more frequent.
    Shards have symbols of their own while they lie in one list, so none changes another's counts
    and each gets the grammar that it gets alone.

    ``max_rounds`` (counts gone through) and ``per_round`` (pairs replaced together) end it sooner; neither is set in production.
    """
    least = max(2, min_count)
    firsts = [int(ids.max(initial=0)) + 1 for ids in shards]
    bases, starts = np.cumsum([0, *firsts]), np.cumsum([0, *map(len, shards)])
    n, first = int(starts[-1]), int(bases[-1])
    # a list of symbols linked both ways; -1 is no symbol: one that has gone, or the end (place n). What belongs to a place lies together.
    seq, nxt, prv, pair = np.empty((n + 1, 4), np.int32).T
    for ids, base, a, b in zip(shards, bases, starts[:-1], starts[1:]):
        seq[a:b] = ids.astype(np.int32) + np.int32(base)
    nxt[:], prv[:] = np.arange(1, n + 2), np.arange(-1, n)
    seq[n], prv[0] = -1, n
    # The pair that begins at a place, -1 for none that repeats. Where a pair of one symbol with itself overlaps another such
    # it is written as -2 - pair: what its count loses is not the number of places it loses, so that is found when its turn comes.
    pair[:] = -1
    # Of each pair: the (greatest possible) count, its symbols, and its slice of ``places``, which keeps
    # places that have gone. Pairs with a new symbol come up only when that is made, so slices never grow.
    count, (begin, end, left, right) = np.zeros(2 * n + 1, np.int32), np.empty((2 * n + 1, 4), np.int32).T
    overlaps = np.zeros(2 * n + 1, bool)
    places = np.empty(3 * n, np.int32)
    turn = np.zeros(2 * n + 2, np.int32)  # of pairs replaced together, from 1
    rules, spots, n_rules, n_pairs, n_places = [np.empty((0, 2), np.int32)], [np.empty(0, np.int32)], 0, 0, 0
    place_bits = np.int64(n.bit_length())

    def add(at: np.ndarray, key: np.ndarray, bits: np.int64) -> None:
        """Count the pairs ``key`` that begin at the places ``at`` (all of these pairs' places); a pair's places are kept in order."""
        nonlocal n_pairs, n_places
        if 2 * bits + place_bits < 64:
            key <<= place_bits
            key |= at
            key.sort()
            at = key & ((1 << place_bits) - 1)
            key >>= place_bits
        else:
            order = np.lexsort((at, key))
            key, at = key[order], at[order]
        again = np.flatnonzero(key[1:] == key[:-1])
        if not len(again):
            return
        breaks = np.flatnonzero(again[1:] - again[:-1] > 1)
        opens, k = again[np.concatenate([[0], breaks + 1])], len(breaks) + 1
        size = again[np.concatenate([breaks, [-1]])] + 2 - opens
        if least > 2:
            opens, size = opens[size >= least], size[size >= least]
            k = len(opens)
        ends = np.cumsum(size)
        total = int(ends[-1]) if k else 0
        at = at[np.arange(total) + np.repeat(opens - (ends - size), size)]
        key = key[opens]
        new = slice(n_pairs, n_pairs + k)
        count[new], begin[new], end[new] = size, ends - size + n_places, ends + n_places
        a, b = key >> bits, key & ((1 << bits) - 1)
        left[new], right[new] = a, b
        name, alike = np.repeat(np.arange(n_pairs, n_pairs + k, dtype=np.int32), size), a == b
        if alike.any():
            own = np.flatnonzero(np.repeat(alike, size))
            close = nxt[at[own[:-1]]] == at[own[1:]]
            if close.any():
                own = own[np.append(close, False) | np.append(False, close)]
                overlaps[name[own]] = True
                name[own] = -2 - name[own]
        pair[at] = name
        places[n_places:n_places + total] = at
        n_pairs, n_places = n_pairs + k, n_places + total

    bits = np.int64(first.bit_length())
    for a, b in zip(starts[:-1], starts[1:]):
        wide = seq[a:b].astype(np.int64)
        add(np.arange(a, b - 1), wide[:-1] << bits | wide[1:], bits)
    often, shard, tops, floor, level, rounds = np.empty(0, np.int64), None, None, 0, None, 0  # pairs that may occur ``floor`` times

    def shard_of(pairs: np.ndarray) -> np.ndarray:
        return np.searchsorted(starts, places[begin[pairs]], "right") - 1

    while n_pairs:
        now = count[often]
        if shard is None:
            top = int(now.max(initial=0))
            chosen = now == top
        else:  # each shard's most frequent pairs
            tops = np.zeros(len(shards), np.int32)
            np.maximum.at(tops, shard, now)
            top = int(tops.max())
            tops[tops < floor] = -1
            chosen = now == tops[shard]
        if top < max(floor, 1):
            top = int(count[:n_pairs].max())
            if top < least:
                break
            shard = None
            if top <= _LOW:
                floor = top
                often = np.flatnonzero(count[:n_pairs] >= floor)
            else:
                floor = max(least, (top + 1) // 2)
                if len(shards) > 1:
                    often = np.flatnonzero(count[:n_pairs] > _LOW)
                    shard, now = shard_of(often), count[often]
                    tops = np.zeros(len(shards), np.int32)
                    np.maximum.at(tops, shard, now)
                    floor = max(least, _LOW + 1, (int(tops[tops > _LOW].min()) + 1) // 2)
                    often, shard = often[now >= floor], shard[now >= floor]
                else:
                    often = np.flatnonzero(count[:n_pairs] >= floor)
            continue
        if top != level:
            if rounds == max_rounds:
                break
            rounds, level = rounds + 1, top
        some = often[chosen][:per_round]
        if len(often) > 64 and 2 * np.count_nonzero(live := now >= floor) < len(often):
            often = often[live]
            shard = shard if shard is None else shard[live]
        alike = overlaps[some].any()
        if len(some) == 1 and not alike:
            i = places[begin[some[0]]:end[some[0]]]
            i = i[pair[i] == some[0]].astype(np.intp)
            j = nxt[i].astype(np.intp)
            over, x = pair[j], np.full(len(i), first + n_rules, np.int32)
        else:
            size = end[some] - begin[some]
            ends = np.cumsum(size)
            x = np.repeat(np.arange(len(some), dtype=np.int32), size)
            i, which = places[np.arange(ends[-1]) + (begin[some] - (ends - size))[x]].astype(np.intp), some[x]
            name = pair[i]
            here = np.flatnonzero((name == which) | (name == -2 - which) if alike else name == which)
            if len(here) < len(i):
                i, x = i[here], x[here]
            if alike:
                # of a run of overlapping occurrences every second is taken
                run, at = np.append(True, (nxt[i[:-1]] != i[1:]) | (x[:-1] != x[1:]))[:len(i)], np.arange(len(i))
                taken = (at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0
                i, x = i[taken], x[taken]
                found = np.bincount(x, minlength=len(some))
                full = found == count[some]
                if not full.all():
                    count[some] = found
                    continue
            j = nxt[i].astype(np.intp)
            over = pair[j]
            turn[some] = np.arange(1, len(some) + 1)
            other = turn[np.maximum(over, -2 - over)] - 1
            turn[some] = 0
            shared = np.flatnonzero((other >= 0) & (other != x))
            if len(shared):
                free = _independent(x[shared], other[shared], len(some))
                whole = np.flatnonzero(free[x])
                i, j, over, x = i[whole], j[whole], over[whole], (np.cumsum(free, dtype=np.int32) - 1)[x[whole]]
                some = some[free]
            x += first + n_rules
        before, after = prv[i].astype(np.intp), nxt[j].astype(np.intp)
        seq[i], seq[j] = x, -1
        nxt[i], prv[after] = after, i
        pair[i] = pair[j] = -1
        near = pair[before]
        # a pair of the new symbol and a neighbour repeats only where the pair that it takes the place of did
        ahead, back = np.flatnonzero(over != -1), np.flatnonzero(near != -1)
        i, before = i[ahead], before[back]
        gone = np.concatenate([over[ahead], near[back]])
        np.subtract.at(count, gone[gone >= 0].astype(np.intp), np.int32(1))
        count[some] = 0
        pair[before] = -1
        rules.append(np.stack([left[some], right[some]], 1))
        spots.append(places[begin[some]])
        n_rules += len(some)
        bits, old = np.int64((first + n_rules).bit_length()), n_pairs
        if len(gone):
            key = np.concatenate([x[ahead], seq[before]]).astype(np.int64) << bits | np.concatenate([seq[after[ahead]], x[back]])
            add(np.concatenate([i, before]), key, bits)
        if n_pairs > old:
            more = np.flatnonzero(count[old:n_pairs] >= floor) + old
            if len(more):
                often = np.concatenate([often, more])
                if shard is not None:
                    shard = np.concatenate([shard, shard_of(more)])
    # each shard's symbols and rules under numbers of its own
    both, of = np.concatenate(rules), np.searchsorted(starts, np.concatenate(spots), "right") - 1
    own, out = np.empty(first + n_rules, np.uint32), []
    own[:first] = np.arange(first) - np.repeat(bases[:-1], firsts)
    for g, a in enumerate(firsts):
        mine = np.flatnonzero(of == g)
        own[first + mine] = np.arange(a, a + len(mine))
        symbols = seq[starts[g]:starts[g + 1]]
        out.append((own[symbols[symbols >= 0]], own[both[mine]], a))
    return out


def compress(ids: np.ndarray, min_count: int = MIN_COUNT, per_round: int | None = None, max_rounds: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, rules, first nonterminal) of one shard."""
    return compress_together([ids], min_count, per_round, max_rounds)[0]


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each nonterminal stands for (its parts are symbols before it)."""
    lengths = [1] * first
    for a, b in rules.tolist():
        lengths.append(lengths[a] + lengths[b])
    return np.array(lengths[first:], np.uint32)


def _expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    return Shard(rules, expansion_lengths(rules, first), None, None, first, 0, None)._opened(symbols)


def _bytes_for(n: int) -> int:
    """Bytes that numbers below ``n`` take."""
    return max(1, -(-(n - 1).bit_length() // 8))


def _narrow(numbers: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number, little-endian."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _widen(rows: np.ndarray) -> np.ndarray:
    """Numbers of rows of bytes, as :func:`_narrow` wrote them."""
    wide = np.zeros((len(rows), 4), np.uint8)
    wide[:, :rows.shape[1]] = rows
    return wide.view("<u4")[:, 0]


def pack(ids: np.ndarray, docs: pa.RecordBatch, grammar: tuple[np.ndarray, np.ndarray, int] | None = None) -> bytes:
    """A file: header, rules, expansion lengths, marks, symbols, then the documents (doc_id, n_tokens) as an Arrow stream."""
    symbols, rules, first = grammar or compress(ids)
    lengths = expansion_lengths(rules, first)
    wide = np.append(np.ones(first, np.int64), lengths)[symbols]
    marks = (np.cumsum(wide) - wide)[::_MARK].astype("<u8")
    width, length_width = _bytes_for(first + len(rules)), _bytes_for(int(lengths.max(initial=0)) + 1)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(docs)
    head = struct.pack(_HEAD, _MAGIC, first, len(rules), width, length_width, len(symbols), len(ids))
    return b"".join([head, _narrow(rules.ravel(), width), _narrow(lengths, length_width), marks.tobytes(),
                     _narrow(symbols, width), sink.getvalue().to_pybytes()])


@dataclass
class Shard:
    """A file opened for reading; symbols (rows of bytes) are mapped from ``data`` and opened only where they are asked for."""

    rules: np.ndarray
    lengths: np.ndarray
    marks: np.ndarray
    symbols: np.ndarray
    first: int
    n_ids: int
    docs: pa.Table

    @classmethod
    def of(cls, data: bytes) -> Shard:
        magic, first, n_rules, width, length_width, n_symbols, n_ids = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a grammar file")
        at = struct.calcsize(_HEAD)

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        def rows(n: int, wide: int) -> np.ndarray:
            return part("u1", n * wide).reshape(n, wide)

        rules, lengths = _widen(rows(2 * n_rules, width)).reshape(-1, 2), _widen(rows(n_rules, length_width))
        marks, symbols = part("<u8", -(-n_symbols // _MARK)), rows(n_symbols, width)
        return cls(rules, lengths, marks, symbols, first, n_ids, pa.ipc.open_stream(pa.py_buffer(data)[at:]).read_all())

    @cached_property
    def _wide(self) -> np.ndarray:
        """How many ids each symbol stands for."""
        return np.append(np.ones(self.first, np.int64), self.lengths)

    @cached_property
    def _written_out(self) -> tuple[int, np.ndarray, np.ndarray]:
        """(most, ids, begins): the ids of every symbol that stands for at most ``most``, one after the other, and where each
        begins. Few nonterminals stand for many, so that is all of them unless they stand for more ids than the shard has."""
        size = np.sort(self.lengths)
        fit = int(np.searchsorted(np.cumsum(size, dtype=np.int64), max(self.n_ids, _MARK), "right"))
        most = int(size[fit]) - 1 if fit < len(size) else int(size[-1]) if len(size) else 1
        wide = np.where(self._wide <= most, self._wide, 0)
        return most, self._placed(np.flatnonzero(wide)), np.cumsum(wide) - wide

    def _placed(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that ``symbols`` stand for: each nonterminal is opened at its own place in the output."""
        wide = self._wide[symbols]
        at = np.cumsum(wide) - wide
        out = np.empty(int(wide.sum()), np.uint32)
        while len(symbols):
            open_ = symbols >= self.first
            out[at[~open_]] = symbols[~open_]
            pairs, at = self.rules[symbols[open_] - self.first], at[open_]
            a, b = pairs[:, 0], pairs[:, 1]
            symbols, at = np.concatenate([a, b]), np.concatenate([at, at + self._wide[a]])
        return out

    def _opened(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that ``symbols`` stand for, looked up; longer symbols are opened down to what is written out."""
        wide = self._wide[symbols]
        if wide.sum() < self.n_ids // 8:
            return self._placed(symbols)  # not worth writing out the others
        most, ids, begins = self._written_out
        while (wide > most).any():
            open_ = wide > most
            place = np.cumsum(open_ + 1) - 1  # of a symbol, or of the second of its two
            pairs, opened = self.rules[symbols[open_] - self.first], np.empty(len(symbols) + len(np.flatnonzero(open_)), np.int64)
            opened[place] = symbols
            opened[place[open_] - 1], opened[place[open_]] = pairs[:, 0], pairs[:, 1]
            symbols = opened
            wide = self._wide[symbols]
        return ids[np.arange(int(wide.sum())) + np.repeat(begins[symbols] - (np.cumsum(wide) - wide), wide)]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols that cover them are opened."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self.marks, start, "right")) - 1
        b = int(np.searchsorted(self.marks, stop, "left"))
        span, before = _widen(self.symbols[a * _MARK:b * _MARK]), int(self.marks[a])
        wide = self._wide[span]
        ends = before + np.cumsum(wide)
        i, j = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        offset = int(ends[i] - wide[i])
        return self._opened(span[i:j])[start - offset:stop - offset]

    def all(self) -> np.ndarray:
        return self._opened(_widen(self.symbols))


# -------------------------------------------------------------------- files
def _buckets(docs: DataFrame, rows_per_bucket: int) -> tuple[Column, int]:
    """A column giving each doc_id its bucket (in id order, some ``rows_per_bucket`` documents each) and how many there are."""
    n = min(MAX_BUCKETS, docs.count() // rows_per_bucket)
    cuts = docs.agg(F.percentile_approx("doc_id", [k / (n + 1) for k in range(1, n + 1)], max(10_000, 10 * n)).alias("c")).first()["c"] if n else []
    bounds = sorted(set(cuts or []))
    return _place(F.col("doc_id"), bounds), len(bounds) + 1


def _place(key: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` lie below ``key`` (0 for null)."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    array, lo, hi = F.lit(bounds), F.lit(0), F.lit(len(bounds))
    packed = F.struct(lo.alias("lo"), hi.alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = (acc["lo"] < acc["hi"]) & (F.try_element_at(array, mid + 1) < key)
        return F.struct(F.when(right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(right | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(steps + 1)), packed, step)["lo"])


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END_ID, max_shard_ids: int = MAX_SHARD_IDS,
          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Write grammar files; (file, bucket, part, n_ids, n_docs) per file, in (bucket, part) order. Stage the result: each evaluation writes anew."""
    rows = docs.select("doc_id", "text")
    bucket, n = _buckets(rows, rows_per_bucket)
    schema = pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("n_docs", pa.int64())])
    tail = np.array([end], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("encoder", tokenizer), lambda: Encoder(tokenizer))
        at, part, held, ids, lengths, full = None, 0, [], [], [], []

        def close() -> None:
            index = pa.RecordBatch.from_arrays([pa.concat_arrays(held), pa.array(lengths, pa.int64())], names=["doc_id", "n_tokens"])
            full.append((at, part, np.frombuffer(b"".join(ids), "<u4"), index))
            for x in (held, ids, lengths):
                x.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            for (b, k, body, index), grammar in zip(full, compress_together([f[2] for f in full]), strict=True):
                uri, out = create(folder, "grammar", ".rpg")
                with out:
                    out.write(pack(body, index, grammar))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((uri, b, k, len(body), index.num_rows), schema.types, strict=True)], schema=schema)
            full.clear()

        size = 0
        for batch in batches:
            keys = batch.column("doc_id")
            for i, (b, data) in enumerate(zip(batch.column("bucket").to_pylist(), encoder.encode_all(batch.column("text")), strict=True)):
                if lengths and (b != at or size + len(data) // 4 >= max_shard_ids):
                    close()
                    part, size = (part + 1 if b == at else 0), 0
                    if len(full) >= SHARDS_TOGETHER or len(full[-1][2]) > max_shard_ids:  # a long document's shard may be large
                        yield from flush()
                at = b
                ids += [data, tail]
                lengths.append(len(data) // 4 + 1)
                size += lengths[-1]
                held.append(keys.slice(i, 1))
        if lengths:
            close()
            yield from flush()

    dealt = (rows.withColumn("bucket", bucket.cast("int")).repartitionById(n, F.col("bucket"))
             .sortWithinPartitions("bucket", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")))
    return dealt.mapInArrow(shards, "file string, bucket int, part int, n_ids long, n_docs long")


def starts(files: DataFrame, group: int = 1024) -> DataFrame:
    """``files`` with ``start``: the ids of all files before it (summed in buckets, then in groups of buckets)."""
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    f = files.withColumn("__group", F.floor(F.col("bucket") / group))
    f = f.withColumn("__in", before(Window.partitionBy("__group").orderBy("bucket", "part")))
    groups = f.groupBy("__group").agg(F.sum("n_ids").alias("n_ids"))  # a row for each ``group`` buckets
    groups = groups.select("__group", before(Window.orderBy("__group")).alias("__before"))
    return f.join(groups, "__group").withColumn("start", F.col("__before") + F.col("__in")).select(*files.columns, "start")


def read(files: DataFrame, doc_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files (columns file and start), decoded."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_file(uri) as f:
                    shard = Shard.of(f.read())
                ids = shard.all().astype("<u4")
                n = shard.docs.column("n_tokens").to_numpy()
                ends = np.cumsum(n)
                if len(ids) != shard.n_ids or (len(ends) and ends[-1] != shard.n_ids):
                    raise ValueError(f"{uri} holds {len(ids)} ids, not {shard.n_ids}")
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([shard.docs.column("doc_id").combine_chunks(), pa.array(start + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(sums, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # files are of bounded size and read one after the other: a task reads several, more where there are many
    return (files.select("file", "start").repartition(max(1, min(MAX_READERS, -(-files.count() // FILES_PER_READER))))
            .mapInArrow(decode, f"doc_id {doc_type}, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, folder: str, tokenizer: str | None = None, **how) -> DataFrame:
    """Written, read back: doc_id, start, n_tokens, ids_crc32 per document."""
    files = stage(write(docs, folder, tokenizer or byte_bpe_file(), **how), "grammar-files")
    return read(stage(starts(files), "grammar-starts"), docs.schema["doc_id"].dataType.simpleString())
