"""Byte-pair encoding by a tokenization automaton (operator 2).

*Compile.* The automaton starts as one state with an arc for every byte. The merge list
is applied in order; merge ``(u, v) -> w`` at step ``k`` is one **merge gadget**: the
state reached by ``u`` is copied without its arc ``v`` (the copy is state ``k``, and
``u`` now leads there), and ``w`` becomes an arc that leads where ``v`` led. An arc ``x``
that was built on an arc missing from a state at the time ``x`` was built is missing
there too. What is left after the last gadget is deterministic and accepts exactly one
token sequence for every byte string: the one the merges give.

*Tables.* A state is reached by one kind of arc, so it is named by the last token. Four
tables hold the automaton: the arc labels (bytes of each token), the gadget table
``(u, v) -> k``, and for each token its two halves with the step that built it.
``step(t, x)`` reads them: arc ``x`` leaves the state of ``t`` unless some gadget removed
an arc on ``x``'s left edge from a state on ``t``'s right edge before either was built
over. Results are kept in a transition cache.

*Encode.* Text is split by the tokenizer's own pattern; each distinct piece is walked
through the automaton once per task (longest arc first; a position from which no path
leads on is marked and never tried twice, so time is linear in the piece), and its ids
are cached as bytes. *Decode* emits the arc labels.

Special tokens found in the text become their own ids, as the tokenizers library does
unless told otherwise.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_bytes

# The pre-split pattern of byte-level BPE vocabularies.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same pattern for the standard engine (twice as fast). Its classes agree with the
# Unicode ones on the characters that _ODD lets through; other texts take the exact engine.
_PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
# one search over many chunks: a NUL stands between them and counts as the end of text
_CHUNKS = re.compile(_PLAIN_PATTERN.replace(r"(?!\S)", r"(?![^\s\0])").replace(r"[^\s\w]", r"[^\s\w\0]") + r"|\0")
_EXACT = regex.compile(PIECE_PATTERN)
# texts that are split whole: other characters, or a space that no visible character follows
_ODD = (r"[^\x01-\x1b\x20-\x{b1}\x{b4}-\x{b8}\x{ba}\x{bb}\x{bf}-\x{24f}\x{2010}-\x{2027}\x{2030}-\x{205e}]"
        r"| [\s\x0b\x{85}\x{a0}]| \z")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, as byte-level vocabulary files spell bytes.

    Bytes that print as one visible character stand for themselves; the others take
    the code points from 256 on, in byte order.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """Deterministic token automaton of a merge list; see the module text.

    ``vocab``: token bytes to id, all 256 single bytes included. ``merges``: pairs in
    order (a token's bytes spell one path before it is built, so one merge builds it; others
    that would are never followed). ``special``: text to id, cut out of the
    text before anything else.
    """

    #: entries kept in the transition cache
    MAX_TRANSITIONS = 1 << 20

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int] | None = None):
        self.special = dict(special or {})
        self.arcs: dict[bytes, int] = {bytes([b]): vocab[bytes([b])] for b in range(256)}
        never = len(merges) + 1
        # edges of an arc: (token, step at which it is built over inside the arc)
        self.left_edge: dict[int, tuple] = {t: ((t, never),) for t in self.arcs.values()}
        self.right_edge: dict[int, tuple] = dict(self.left_edge)
        self.gadget: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(merges, 1):
            u, v, w = self.arcs.get(a), self.arcs.get(b), vocab[a + b]
            if u is None or v is None or not self.step(u, v):
                continue                        # u is never followed by v: nothing to merge
            self.gadget[(u, v)] = k             # state k: the state of u without arc v
            self.arcs[a + b] = w                # arc w leads where v led before this step
            self.left_edge[w] = ((w, never), (u, k), *self.left_edge[u][1:])
            self.right_edge[w] = ((w, never), (v, k), *self.right_edge[v][1:])
        self.labels: dict[int, bytes] = {i: b for b, i in vocab.items()}
        self.labels.update({i: s.encode() for s, i in self.special.items()})
        self.longest: dict[bytes, int] = {}
        for piece in self.arcs:
            self.longest[piece[:2]] = max(self.longest.get(piece[:2], 1), len(piece))
        self.transitions: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_json(cls, spec: str) -> Automaton:
        """From the text of a tokenizer file: byte-level BPE without normaliser or prefix space."""
        j = json.loads(spec)
        pre = j["pre_tokenizer"]
        if j["model"]["type"] != "BPE" or j["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        alphabet = byte_alphabet()
        special = {a["content"]: a["id"] for a in j["added_tokens"]}

        def raw(s: str) -> bytes:
            return bytes(alphabet[c] for c in s)
        vocab = {raw(s): i for s, i in j["model"]["vocab"].items() if s not in special}
        merges = [tuple(map(raw, m if isinstance(m, list) else m.split(" "))) for m in j["model"]["merges"]]
        return cls(vocab, merges, special)

    def step(self, t: int, x: int) -> bool:
        """Does the state that arc ``t`` leads to have an arc ``x``?"""
        removed_at = self.gadget.get
        for v, v_until in self.left_edge[x]:
            for u, u_until in self.right_edge[t]:
                k = removed_at((u, v))
                if k is not None and k < u_until and k <= v_until:
                    return False
        return True

    def walk(self, piece: bytes) -> list[int]:
        """Token ids on the one path that spells ``piece``."""
        arcs, longest, known = self.arcs, self.longest, self.transitions
        whole = arcs.get(piece)
        if whole is not None:           # the start state has every arc
            return [whole]
        n = len(piece)
        ids: list[int] = []
        ends, tries = [0], [longest.get(piece[:2], 1)]
        dead: set[int] = set()
        while ends[-1] < n:
            at = ends[-1]
            size = min(tries[-1], n - at)
            while size > 0:
                x = arcs.get(piece[at:at + size])
                if x is not None and at + size not in dead:
                    if not ids:
                        break
                    pair = (ids[-1], x)
                    ok = known.get(pair)
                    if ok is None:
                        if len(known) >= self.MAX_TRANSITIONS:
                            known.clear()
                        ok = known[pair] = self.step(*pair)
                    if ok:
                        break
                size -= 1
            if size > 0:
                tries[-1] = size - 1
                ids.append(x)
                ends.append(at + size)
                tries.append(longest.get(piece[at + size:at + size + 2], 1))
            else:                       # no arc leads on from here
                dead.add(at)
                ends.pop()
                tries.pop()
                ids.pop()
        return ids


class Tables:
    """The automaton as arrays, small enough (a few MB, fixed by the vocabulary) to broadcast.

    A byte trie of all arcs with the longest arc that ends at each node, the next shorter
    arc for each token, both edges of each token with their steps, and the sorted gadgets.
    """

    def __init__(self, automaton: Automaton):
        self.special = automaton.special
        self.labels = automaton.labels
        arcs, size = automaton.arcs, max(automaton.labels) + 1
        node: dict[bytes, int] = {b"": 0}
        for piece in arcs:
            for n in range(1, len(piece) + 1):
                node.setdefault(piece[:n], len(node))
        strings = sorted(node, key=len)
        # nodes by depth, so that a node's suffix always has a smaller number
        node = {s: i for i, s in enumerate(strings)}
        self.parent = np.array([node[s[:-1]] for s in strings], np.int32)
        self.byte = np.array([s[-1] if s else 0 for s in strings], np.uint8)
        self.depth = np.array([len(s) for s in strings], np.int16)
        self.fail = np.zeros(len(strings), np.int32)
        self.ends = np.full(len(strings), -1, np.int32)
        self.shorter = np.full(size, -1, np.int32)
        self.length = np.zeros(size, np.int32)
        for i, s in enumerate(strings[1:], 1):
            self.fail[i] = f = node[next(s[k:] for k in range(1, len(s) + 1) if s[k:] in node)]
            own = arcs.get(s)
            self.ends[i] = self.ends[f] if own is None else own
            if own is not None:
                self.shorter[own] = self.ends[f]
        for i, label in self.labels.items():
            self.length[i] = len(label)
        self.left, self.left_until = self._edges(automaton.left_edge, size)
        self.right, self.right_until = self._edges(automaton.right_edge, size)
        pairs = sorted((u << 32 | v, k) for (u, v), k in automaton.gadget.items())
        self.gadgets = np.array([p for p, _ in pairs], np.int64)
        self.steps = np.array([k for _, k in pairs], np.int32)

    @staticmethod
    def _edges(edge: dict[int, tuple], size: int) -> tuple[np.ndarray, np.ndarray]:
        deep = max(map(len, edge.values()))
        token, until = np.full((deep, size), -1, np.int32), np.zeros((deep, size), np.int32)
        for t, e in edge.items():
            for d, (x, k) in enumerate(e):
                token[d, t], until[d, t] = x, k
        return token, until

    @classmethod
    def load(cls, path: str) -> Tables:
        """From a tokenizer file that the driver can read."""
        with open(path, encoding="utf-8") as f:
            return cls(Automaton.from_json(f.read()))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the runs [start, start + count), one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


_MIX, _DOWN = np.int64(-7046029254386353131), np.uint64(64 - 21)


class Encoder:
    """Batches of texts to ids and back, driven by the tables of one automaton.

    Each distinct piece of a batch is encoded once, all pieces side by side: byte by byte,
    the last token of every prefix is the longest arc that ends there and that the state
    of the prefix before it has. Memory is bounded by the batch (callers pass slices of a
    few MB) and by the slots for cached transitions.
    """

    SLOTS = 1 << 21
    #: longer pieces take the one-by-one walk, in linear time and memory
    WIDE = 48
    BLOCK = 1 << 15

    def __init__(self, tables: Tables):
        self.t = tables
        special = sorted(tables.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        n = len(tables.parent)
        self.next = np.zeros((n, 256), np.int32)
        for d in range(int(tables.depth.max()) + 1):
            at = np.flatnonzero(tables.depth == d)
            if d:
                self.next[at] = self.next[tables.fail[at]]
            below = np.flatnonzero(tables.depth == d + 1)
            self.next[tables.parent[below], tables.byte[below]] = below
        # transitions known so far, in a hash table
        self.keys, self.allowed, self.filled = np.full(self.SLOTS, -1, np.int64), np.zeros(self.SLOTS, bool), 0
        self.labels = tables.labels
        self.gadget: dict[int, int] | None = None    # for single long pieces

    # -- transitions ---------------------------------------------------------
    def _compute(self, last: np.ndarray, arc: np.ndarray) -> np.ndarray:
        t, bad = self.t, np.zeros(len(last), bool)
        for v, v_until in zip(t.left[:, arc], t.left_until[:, arc]):
            for u, u_until in zip(t.right[:, last], t.right_until[:, last]):
                live = np.flatnonzero((u >= 0) & (v >= 0) & ~bad)
                if not len(live):
                    continue
                key = u[live].astype(np.int64) << 32 | v[live]
                at = np.minimum(np.searchsorted(t.gadgets, key), len(t.gadgets) - 1)
                k = t.steps[at]
                bad[live] = (t.gadgets[at] == key) & (k < u_until[live]) & (k <= v_until[live])
        return ~bad

    def _probe(self, key: np.ndarray) -> np.ndarray:
        """Slot of each key, or of the free slot where it would go (linear probing)."""
        at = (key * _MIX).view(np.uint64) >> _DOWN
        at = at.astype(np.int64)
        slot = self.keys[at]
        todo = np.flatnonzero((slot != key) & (slot >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.SLOTS - 1)
            slot = self.keys[at[todo]]
            todo = todo[(slot != key[todo]) & (slot >= 0)]
        return at

    def step(self, last: np.ndarray, arc: np.ndarray) -> np.ndarray:
        """For each pair: does the state that token ``last`` leads to have the arc?"""
        key = last.astype(np.int64) << 32 | arc
        at = self._probe(key)
        new = self.keys[at] < 0
        if new.any():
            pairs = np.unique(key[new])
            if self.filled + len(pairs) > self.SLOTS // 2:
                if len(pairs) > self.SLOTS // 4:
                    return self._compute(last, arc)
                self.keys[:], self.filled = -1, 0
                pairs = np.unique(key)
            ok = self._compute(pairs >> 32, pairs & 0xFFFFFFFF)
            self.filled += len(pairs)
            left = np.arange(len(pairs))
            while len(left):            # of those that meet in a slot one goes in a round
                to = self._probe(pairs[left])
                self.keys[to] = pairs[left]
                self.allowed[to] = ok[left]
                stays = self.keys[to] == pairs[left]
                self.allowed[to[stays]] = ok[left[stays]]
                left = left[~stays]
            at = self._probe(key)
        return self.allowed[at]

    def _block(self, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most WIDE bytes, rows of ``text``, by falling size: flat, counts."""
        wide, n = int(size[0]), len(size)
        last = np.full((wide + 1, n), -1, np.int64)
        node = np.zeros(n, np.int32)
        t = self.t
        for i in range(1, wide + 1):
            m = int(np.searchsorted(-size, -i, side="right"))
            node = self.next[node[:m], text[:m, i - 1]]
            arc, todo = t.ends[node].astype(np.int64), np.arange(m)
            done = last[i]
            while len(todo):
                a = arc[todo]
                before = last[i - t.length[a], todo]
                ok = before < 0                     # the start state has every arc
                if not ok.all():
                    check = np.flatnonzero(~ok)
                    ok[check] = self.step(before[check], a[check])
                done[todo[ok]] = a[ok]
                todo = todo[~ok]
                arc[todo] = t.shorter[arc[todo]]
        mark = np.zeros((n, wide + 1), bool)
        at, rows = size.copy(), np.arange(n)
        while len(rows):
            mark[rows, at[rows]] = True
            at[rows] -= t.length[last[at[rows], rows]]
            rows = rows[at[rows] > 0]
        return last.T[mark].astype(np.uint32), mark.sum(axis=1)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces: flat ids and where each piece's ids start (n + 1)."""
        n = len(pieces)
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, n + 1, 8 * pieces.offset)
        data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        counts, flat, n_wide = np.zeros(n, np.int64), [], int((size > self.WIDE).sum())
        for i in order[:n_wide]:
            ids = self._one(data[offsets[i]:offsets[i + 1]].tobytes())
            flat.append(np.array(ids, np.uint32))
            counts[i] = len(ids)
        for k in range(n_wide, n, self.BLOCK):
            own = order[k:k + self.BLOCK]
            sizes = size[own]
            text = np.zeros((len(own), int(sizes[0])), np.uint8)
            text[np.arange(text.shape[1]) < sizes[:, None]] = data[_spread(offsets[own], sizes)]
            ids, counts[own] = self._block(text, sizes)
            flat.append(ids)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        ends = np.cumsum(counts[order])
        starts = np.empty(n, np.int64)
        starts[order] = ends - counts[order]
        return flat[_spread(starts, counts)], np.concatenate([[0], np.cumsum(counts)])

    def _one(self, piece: bytes) -> list[int]:
        """One long piece over the same tables; the last arc of each prefix is kept."""
        t, node, last = self.t, 0, [-1]
        if self.gadget is None:
            self.gadget = dict(zip(t.gadgets.tolist(), t.steps.tolist()))
            self.ends, self.shorter, self.length = t.ends.tolist(), t.shorter.tolist(), t.length.tolist()
        ends, shorter, length, gadget = self.ends, self.shorter, self.length, self.gadget
        known: dict[tuple[int, int], bool] = {}
        edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}

        def edge(x: int, left: bool) -> list[tuple[int, int]]:
            got = edges.get((x, left))
            if got is None:
                token, until = (t.left, t.left_until) if left else (t.right, t.right_until)
                got = edges[(x, left)] = [(i, k) for i, k in zip(token[:, x].tolist(), until[:, x].tolist()) if i >= 0]
            return got

        def step(before: int, arc: int) -> bool:
            for u, u_until in edge(before, False):
                for v, v_until in edge(arc, True):
                    k = gadget.get(u << 32 | v)
                    if k is not None and k < u_until and k <= v_until:
                        return False
            return True
        for i, b in enumerate(piece, 1):
            node = int(self.next[node, b])
            arc = ends[node]
            while (before := last[i - length[arc]]) >= 0:
                ok = known.get((before, arc))
                if ok is None:
                    if len(known) >= self.SLOTS:
                        known.clear()
                    ok = known[(before, arc)] = step(before, arc)
                if ok:
                    break
                arc = shorter[arc]
            last.append(arc)
        ids, n = [], len(piece)
        while n:
            ids.append(last[n])
            n -= length[last[n]]
        return ids[::-1]

    # -- texts ---------------------------------------------------------------
    def _exact(self, text: str) -> list[str]:
        """Pieces of a text, special tokens included."""
        if self.cut is None or not self.cut.search(text):
            return _EXACT.findall(text)
        return [x for s in self.cut.split(text) if s
                for x in ([s] if s in self.t.special else _EXACT.findall(s))]

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts: flat ids (uint32), and where each text's ids start (n + 1).

        A text in which every space stands before a visible character is cut before its
        spaces, for a piece starts there; its distinct chunks are split into pieces. Other
        texts, and those with characters on which the two engines differ, are split whole.
        """
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string())
        odd = pc.match_substring_regex(texts, _ODD)
        if self.cut is not None:
            for s in self.t.special:
                odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = pc.replace_substring(pc.if_else(pa.array(~odd), texts, pa.scalar("", pa.large_string())), " ", "\0 ")
        split = pc.split_pattern(plain, "\0")
        n_chunks = np.diff(split.offsets.to_numpy())
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        together = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.string())), "\0")
        found = _CHUNKS.findall(together[0].as_py())
        if len(coded.dictionary):
            found.append("\0")
        if odd.any():                   # one more chunk for each odd text, which stands as an empty one so far
            at = np.flatnonzero(odd)
            index[(np.cumsum(n_chunks) - n_chunks)[at]] = np.arange(len(coded.dictionary), len(coded.dictionary) + len(at))
            for text in texts.filter(pa.array(odd)).to_pylist():
                found += self._exact(text)
                found.append(None)
        pieces = pa.array(found, pa.large_string()).dictionary_encode()
        # a chunk ends at each separator, an odd text at each null
        at = pieces.indices.fill_null(-1).to_numpy()
        n_plain = len(coded.dictionary)
        zero = pc.index(pieces.dictionary, pa.scalar("\0", pa.large_string())).as_py()
        ends = np.flatnonzero(at == zero)[:n_plain] if n_plain else np.zeros(0, np.int64)
        ends = np.concatenate([ends, np.flatnonzero(at < 0)])
        n_pieces = np.diff(np.concatenate([[-1], ends])) - 1
        piece_at = np.delete(at, ends)
        flat, starts = self._pieces(pieces.dictionary)
        for s, token in self.t.special.items():
            k = pc.index(pieces.dictionary, pa.scalar(s, pa.large_string())).as_py()
            if k >= 0:                  # an arc of its own, whatever its bytes would give
                flat = np.concatenate([flat[:starts[k]], [np.uint32(token)], flat[starts[k + 1]:]])
                starts = np.concatenate([starts[:k + 1], starts[k + 1:] - (starts[k + 1] - starts[k] - 1)])
        n_ids = np.diff(starts)
        chunk_ids = flat[_spread(starts[piece_at], n_ids[piece_at])]
        piece_ends = np.concatenate([[0], np.cumsum(n_ids[piece_at])])
        bounds = piece_ends[np.concatenate([[0], np.cumsum(n_pieces)])]
        size = np.diff(bounds)
        ids = chunk_ids[_spread(bounds[:-1][index], size[index])]
        ends = np.concatenate([[0], np.cumsum(size[index])])
        return ids.astype(np.uint32, copy=False), ends[np.concatenate([[0], np.cumsum(n_chunks)])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the emitted arc labels; stray bytes become the replacement character."""
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


# -- the operator on tables --------------------------------------------------
#: text bytes encoded at once: the more, the fewer distinct pieces a byte
SLICE = 6 << 20
_ENCODERS: dict[str, Encoder] = {}


def encoder(tables: Broadcast[Tables], key: str) -> Encoder:
    """This process's encoder for a broadcast automaton (one is kept)."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tables.value)
    return _ENCODERS[key]


def shared_tables(spark: SparkSession, path: str) -> tuple[Broadcast[Tables], str]:
    """The automaton of a tokenizer file, compiled once and broadcast; its key for ``encoder``."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    key = hashlib.sha256(spec.encode()).hexdigest()
    return spark.sparkContext.broadcast(Tables(Automaton.from_json(spec))), key


def binary_slices(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of ids as binary values: little-endian unsigned 32-bit integers."""
    flat = np.ascontiguousarray(flat, "<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(ends, np.int64) * 4), pa.py_buffer(flat)]).cast(pa.binary())


def encode(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
           out_text: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per input row: the id, ``n_tokens``, ``ids`` (binary: little-endian
    unsigned 32-bit integers), and ``decoded`` (string, if ``out_text``). Null and empty texts
    have no ids and decode to the empty string. Null ids are kept, repeated rows give repeated
    results, other columns are not read, an empty table gives an empty one. Very long texts
    are handled whole, alone in their slice.
    """
    tables, key = shared_tables(df.sparkSession, path)
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([source.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
                          + ([T.StructField("decoded", T.StringType())] if out_text else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tables, key)
        for batch in batches:
            for part in by_bytes(batch, text_col, SLICE):
                flat, ends = coder.encode(part.column(text_col).fill_null(""))
                out = [part.column(id_col), pa.array(np.diff(ends)), binary_slices(flat, ends)]
                if out_text:
                    out.append(pa.array([coder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
    return source.mapInArrow(run, schema)
