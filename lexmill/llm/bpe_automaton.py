"""BPE encoding and decoding with a deterministic automaton over tokens, compiled from the merges.

The automaton starts as one state with a loop for each base symbol.  The gadget of a merge (u, v) copies the state that u
leads to without its arc v, redirects u to the copy, and gives each state with an arc u an arc uv to where v led.  So a
state is its parent and the arc that it lost, an arc's target depends on its label alone, and a lost arc v also means the arcs
of all tokens that later began with v.  With tokens numbered in the order of a tree (a token's parent is its left part, late
children first) those are one interval of numbers.  The transition table is stored so: ``target`` for each token and, for each
state that some token leads to, the sorted intervals of the arcs that it lacks.

The automaton accepts exactly one token sequence for each symbol sequence, the one that BPE gives.  Words are read
by table-driven transitions from their first symbol to their last: a trie gives the tokens that start at a place,
the table says which of them the state there has, and as each prefix has one path, nothing is ever taken back.
"""

import hashlib
import json
import re
import unicodedata
from bisect import bisect_right
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import Table, bounded_batches, chunks, cut_at_words, held, joined, slices, tidied

WORDS = 16 << 20  # bytes of a worker's table of words, about
LOCKSTEP, LENGTH = 8192, 48  # words read together, and the symbols from which on a word is read alone


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _gadgets(vocab: dict[str, int], merges: list[tuple[str, str]], symbols: dict[str, int]):
    """Run the merge gadgets: the tokens, their parts and births, the states, and the state that each token leads to.

    A state is (parent, lost arc, time); the first has no parent and all arcs.
    """
    names = {t: i for t, i in vocab.items() if t in symbols}
    parts: dict[int, tuple[int, int]] = {}
    birth = dict.fromkeys(names.values(), 0)
    target = dict.fromkeys(names.values(), 0)
    states: list[tuple[int, int, int]] = [(-1, -1, 0)]
    gone: dict[tuple[int, int], int] = {}  # (u, v) to the time at which the state that u leads to lost its arc v

    def lacks(last: int, token: int) -> bool:
        """Whether the state that ``last`` leads to has no arc ``token``: it, or a left part of it before the token that starts with it was made, was lost."""
        until = 1 << 60
        while True:
            right, bound = last, until  # the state is a copy of where the right parts led before the token was made
            while True:
                if gone.get((right, token), 1 << 61) <= bound:
                    return True
                if right not in parts:
                    break
                bound, right = min(bound, birth[right] - 1), parts[right][1]
            if token not in parts:
                return False
            until, token = birth[token], parts[token][0]

    for time, (u, v) in enumerate(merges, 1):
        a, b, t = names.get(u), names.get(v), vocab.get(u + v)
        if a is None or b is None or t is None or u + v in symbols or lacks(a, b):
            continue  # no path u v exists, so the gadget would change nothing
        leads = target[b]
        states.append((target[a], b, time))
        target[a], gone[a, b] = len(states) - 1, time
        if t not in birth:
            names[u + v], parts[t], birth[t], target[t] = t, (a, b), time, leads
    return names, parts, birth, states, target


def compile_automaton(vocab: dict[str, int], merges: list[tuple[str, str]], end: str) -> dict[str, np.ndarray]:
    """The tables of the automaton and of the trie, as arrays.

    ``target``, ``number`` by token; ``first``, ``last`` of the intervals by ``state * span + number``; ``base``, ``check``,
    ``token`` of the trie over bytes, where 256 more stands for a byte at a word's end (if ``end`` is not empty).
    """
    shown = byte_symbols()
    symbols = {s: b for b, s in enumerate(shown)} | ({s + end: 256 + b for b, s in enumerate(shown)} if end else {})
    names, parts, birth, states, target = _gadgets(vocab, merges, symbols)
    size = max(birth) + 1

    children: dict[int, list[int]] = {}
    by_birth = sorted(parts, key=birth.__getitem__)
    for t in by_birth:
        children.setdefault(parts[t][0], []).append(t)  # early ones first
    weight = dict.fromkeys(birth, 1)
    for t in reversed(by_birth):
        weight[parts[t][0]] += weight[t]
    number = np.full(size, -1, np.int64)
    ends: dict[int, list[int]] = {}  # of a token: where the intervals of its early children end, negated to ascend by birth
    at = 0
    for t in [t for t in birth if t not in parts] + by_birth:
        if t not in parts:
            number[t] = at
            at += weight[t]
        place = int(number[t]) + 1
        for c in reversed(children.get(t, ())):
            number[c] = place
            place += weight[c]
        ends[t] = place
    span = at

    def last_of(token: int, time: int) -> int:
        """Where the numbers of ``token`` and of what began with it from ``time`` on end."""
        kids = children.get(token, ())
        i = bisect_right(kids, time - 1, key=birth.__getitem__)  # those before were born earlier
        return int(number[kids[i - 1]]) if i else ends[token]

    parent = np.array([s[0] for s in states])
    first = np.array([0] + [int(number[arc]) for _, arc, _ in states[1:]])
    last = np.array([0] + [last_of(arc, time) for _, arc, time in states[1:]])
    live = np.unique(np.array([0, *target.values()]))
    rows, cur = [], live.copy()
    own = np.arange(len(live))
    while len(own):
        some = cur > 0
        own, cur = own[some], cur[some]
        rows.append((own * span + first[cur], own * span + last[cur]))
        cur = parent[cur]
    a, b = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((-b, a))
    a, b = a[order], b[order]
    top = np.maximum.accumulate(b) if len(b) else b
    keep = np.ones(len(a), bool)
    keep[1:] = b[1:] > top[:-1]  # intervals are nested or apart, so the rest lie in others
    to = np.zeros(size, np.int32)
    for t, s in target.items():
        to[t] = np.searchsorted(live, s)

    spelled: dict[int, tuple[int, ...]] = {names[s]: (b,) for s, b in symbols.items() if s in names}
    for t in by_birth:
        spelled[t] = spelled[parts[t][0]] + spelled[parts[t][1]]
    return {"target": to, "number": number, "span": np.array([span]), "first": a[keep], "last": b[keep]} | _trie(spelled)


def _trie(spelled: dict[int, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """A trie as arrays: node ``n`` with symbol ``s`` goes to ``base[n] + s`` if ``check`` of that is ``n``."""
    nodes: list[dict[int, int]] = [{}]
    ends = {}
    for t, word in spelled.items():
        n = 0
        for s in word:
            n = nodes[n].setdefault(s, len(nodes))
            if n == len(nodes):
                nodes.append({})
        ends[n] = t
    room = len(nodes) * 4 + 4096
    base, check, token = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
    used, place, hint = np.zeros(room, bool), {0: 0}, {}
    used[0], check[0] = True, -2
    for n in sorted(range(len(nodes)), key=lambda n: -len(nodes[n])):  # wide nodes first; a node's own place may come later
        if not nodes[n]:
            break
        syms = np.array(sorted(nodes[n]))
        b = hint.get(len(syms), 0)
        while True:
            free = ~used[b + np.arange(1024)[:, None] + syms].any(1)
            if free.any():
                break
            b += 1024
        b += int(free.argmax())
        used[b + syms] = True
        hint[len(syms)] = max(0, b - 512)
        for s, c in nodes[n].items():
            place[c] = b + s
        nodes[n]["base"] = b
    for n, kids in enumerate(nodes):
        if kids:
            b = kids.pop("base")
            base[place[n]] = b
            for s in kids:
                check[b + s] = place[n]
        token[place[n]] = ends.get(n, -1)
    top = int(np.flatnonzero(used)[-1]) + 1 + 512  # any symbol from any base stays inside
    return {"base": base[:top], "check": check[:top], "token": token[:top]}


class Automaton:
    """Reads symbols by the compiled tables."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.__dict__.update(tables)
        self.width = int(self.span[0])
        self.lists = {k: memoryview(np.ascontiguousarray(v)) for k, v in tables.items()}

    def read(self, words: list[bytes], marked: bool) -> list[bytes]:
        """The arc labels of each word's path as 32-bit integers; ``marked``: the last symbol is one of a word's end."""
        out: list[bytes] = [b""] * len(words)
        order = sorted((i for i, w in enumerate(words) if w and len(w) <= LENGTH), key=lambda i: -len(words[i]))
        for at in range(0, len(order), LOCKSTEP):
            some = order[at : at + LOCKSTEP]
            for i, ids in zip(some, self._together([words[i] for i in some], marked), strict=True):
                out[i] = ids
        for i, w in enumerate(words):
            if len(w) > LENGTH:
                out[i] = self._alone(w, marked)
        return out

    def _together(self, words: list[bytes], marked: bool) -> list[bytes]:
        """All words, long ones first, a symbol at a time."""
        n = np.array([len(w) for w in words])
        off = np.cumsum(n + 1) - n - 1  # a word has a place before each symbol and one at its end
        sym = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        if marked:
            sym[off + n - 1] += 256
        state, label, size = np.full(len(sym), -1, np.int64), np.zeros(len(sym), np.int32), np.zeros(len(sym), np.int64)
        state[off] = 0
        for s in range(int(n[0])):
            k = int(np.searchsorted(-n, -s, side="left"))  # words longer than s
            at = off[:k] + s
            go = state[at] >= 0
            at, left = at[go], n[:k][go] - s
            q = state[at] * self.width
            node = np.zeros(len(at), np.int64)
            d = 0
            while len(at):
                to = self.base[node] + sym[at + d]
                go = self.check[to] == node
                d += 1
                at, left, q, node = at[go], left[go], q[go], to[go]
                t = self.token[node]
                i = np.flatnonzero(t >= 0)
                key = q[i] + self.number[t[i]]
                j = np.searchsorted(self.first, key, side="right") - 1
                i = i[(j < 0) | (key >= self.last[j])]
                end = at[i] + d
                state[end], label[end], size[end] = self.target[t[i]], t[i], d
                go = left > d
                if not go.all():
                    at, left, q, node = at[go], left[go], q[go], node[go]
        on, cur, first = np.zeros(len(sym), bool), off + n, off.copy()
        if (state[cur] < 0).any():
            raise ValueError("a word without a token sequence")
        while len(cur):
            on[cur] = True
            cur = cur - size[cur]
            go = cur > first
            cur, first = cur[go], first[go]
        places = np.flatnonzero(on)
        ids = label[places].astype("<u4").tobytes()
        cuts = np.append(np.searchsorted(places, off), len(places)).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _alone(self, word: bytes, marked: bool) -> bytes:
        """One long word, by the same tables."""
        n, t_ = len(word), self.lists
        base, check, token, number, first, last, target = (t_[k] for k in ("base", "check", "token", "number", "first", "last", "target"))
        sym = [*word]
        if marked:
            sym[-1] += 256
        state, label, size = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        for s in range(n):
            if state[s] < 0:
                continue
            q, node = state[s] * self.width, 0
            for e in range(s, n):
                to = base[node] + sym[e]
                if check[to] != node:
                    break
                node, t = to, token[to]
                if t >= 0:
                    key = q + number[t]
                    j = bisect_right(first, key) - 1
                    if j < 0 or key >= last[j]:
                        state[e + 1], label[e + 1], size[e + 1] = target[t], t, e + 1 - s
        if state[n] < 0:
            raise ValueError("a word without a token sequence")
        out, e = [], n
        while e:
            out.append(label[e])
            e -= size[e]
        return np.array(out[::-1], "<u4").tobytes()


_LAST = 2**32 - 1  # no token has this id
_END = _LAST.to_bytes(4, "little")
_PLAIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\\sa-z0-9]+|\n", re.ASCII)  # the same over lower-case ASCII, and line ends
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # fixed value: the vocabulary file's split pattern


def compile_file(path: str) -> dict:
    """What a lower-casing word BPE vocabulary file with word-end suffixes says, with the compiled automaton."""
    spec = json.load(open(path, encoding="utf-8"))
    model = spec["model"]
    end = model["end_of_word_suffix"] or ""
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = model["vocab"] | special
    labels = [""] * (max(names.values()) + 1)
    for t, i in names.items():
        labels[i] = t
    return {"tables": compile_automaton(model["vocab"], [tuple(m) for m in model["merges"]], end), "special": special, "labels": labels, "marked": bool(end)}


class WordBpe:
    """Encodes and decodes by a compiled vocabulary."""

    def __init__(self, compiled: dict):
        self.machine, self.special, self.marked = Automaton(compiled["tables"]), compiled["special"], compiled["marked"]
        self.labels = pa.array(compiled["labels"], pa.large_string())
        self.split, self.plain = regex.compile(_PATTERN), _PLAIN
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.mark = commonprefix(list(self.special))
        self.words = Table(lambda ws: self.machine.read([w.encode("utf-8", "replace") for w in ws], self.marked), WORDS)
        self.table = Table(self._solve)

    def _lower(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()  # no final sigma

    def _words(self, chunk: str) -> list:
        """The words (and ids of special tokens) of a chunk."""
        bare = chunk.strip(" \t\n\r\x0b\x0c")
        if bare.isascii() and bare.isalpha():
            return [bare.lower()]
        out: list = []
        for piece in self.apart.split(bare) if self.apart and self.mark in bare else [bare]:
            if piece in self.special:
                out.append(self.special[piece])
            else:
                out.extend(self.split.findall(self._lower(piece)))
        return out

    def _solve(self, asked: list[str]) -> list[bytes]:
        """Ids of chunks.  ASCII ones are split in one go, a line end after each; the others one by one."""
        easy = [c.isascii() and not c.isspace() and not (self.mark and self.mark in c) for c in asked]
        flat = self.plain.findall("\n".join([c for c, e in zip(asked, easy, strict=True) if e]).lower() + "\n")
        hard = [self._words(c) for c, e in zip(asked, easy, strict=True) if not e]
        need = list({*flat, *(w for p in hard for w in p if isinstance(w, str))} - {"\n"})
        ids = dict(zip(need, self.words(need), strict=True)) | {"\n": _END}
        raw = b"".join(map(ids.__getitem__, flat))
        cuts = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == _LAST)).tolist()
        done = iter([raw[a:b] for a, b in zip([0, *[x + 4 for x in cuts[:-1]]], cuts, strict=True)])
        rest = iter([b"".join([ids[w] if isinstance(w, str) else np.uint32(w).tobytes() for w in p]) for p in hard])
        return [next(done) if e else next(rest) for e in easy]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the place where each text starts (and the last ends)."""
        whole = pc.fill_null(pc.match_substring(texts, self.mark), False).to_numpy(zero_copy_only=False) if self.mark else None
        parts, at, bounds = chunks(texts, cut_at_words, whole)  # a text that may hold special tokens is one chunk
        ids, off = joined(self.table(parts), at, bounds)
        return ids.view("<u4"), off // 4

    def decode(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """The labels of the arcs, in order; the vocabulary file has no decoder, so a blank parts them."""
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(off.astype(np.int64)), self.labels.take(pa.array(ids.astype(np.int64)))), pa.scalar(" ", pa.large_string()))


def bpe_round_trip(documents: DataFrame, tokenizer: str, carry: list[str] | None = None, keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """Encode every whole text with the automaton of ``tokenizer`` (a path on the driver), and decode the ids.

    Returns ``doc_id, n_tokens long, ids_sha256 string, decoded_sha256 string``, the columns named in ``carry``, with ``keep_ids``
    ``ids array<int>`` and with ``keep_text`` ``decoded string``; a row for each input row.  A null text counts as empty: no ids, an empty decoded text.
    Null or repeated ids and very long texts are handled like any others; further columns are ignored.  The tables are compiled
    once, on the driver, and their size is that of the vocabulary.
    """
    carry = carry or []
    kept = documents.select("doc_id", *carry, F.col("text").cast("string").alias("text_"))
    schema = kept.drop("text_").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    if keep_text:
        schema = schema.add("decoded", "string")
    compiled = documents.sparkSession.sparkContext.broadcast(compile_file(tokenizer))

    def run(batches):
        bpe = held(("bpe", tokenizer), lambda: WordBpe(compiled.value))
        for batch in batches:
            for part in slices(batch, "text_"):
                ids, off = bpe.encode(part.column("text_"))
                decoded = bpe.decode(ids, off)
                at = off.tolist()
                sha = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                back = [hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded]
                cols = [part.column(c) for c in ("doc_id", *carry)] + [pa.array(np.diff(off)), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.view("<i4"))))
                if keep_text:
                    cols.append(decoded.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    bounded_batches(documents.sparkSession)
    return kept.mapInArrow(tidied(run, keeps=True), schema)
