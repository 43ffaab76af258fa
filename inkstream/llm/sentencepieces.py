"""Offset-preserving SentencePiece (BPE) encoding and decoding.

1. Normalisation reads the source from left to right. At each place the longest prefix that the model's
   compiled character map holds is replaced by its target, else one character is copied. White space is
   then trimmed, escaped and prefixed as the model says. Every character of the normalised text keeps the
   byte offset in the source of what it came from (the alignment).
2. The normalised text is cut before each run of space marks and around control characters, where no piece of
   the vocabulary reaches across. Parts are merged best piece first, leftmost of equals, all unknown parts of a
   group of texts at once as arrays, and remembered, as they repeat across a corpus. Characters of no piece
   become byte pieces (or unknown).
3. Piece lengths add up to places in the normalised text; the alignment projects them to byte spans of the
   source. A character spelt in byte pieces belongs to its last one, the others have empty spans, as has the
   end id.

The compiled map is a double-array trie; it is walked once into a plain one, and texts are searched only
where a key can begin (a one-character key, or any character before one that stands second in some key).

Row-local: one pass over the texts, no shuffle. The model file is of bounded size and broadcast; its path is
a parameter.

Cases: a null text counts as empty and gives the end id alone; texts are taken in groups and very long ones in
pieces of about ``PIECE`` characters, long parts are merged with a heap, O(n log n); repeated rows and null ids give one result row
each; an empty table gives no rows; other columns are ignored. Decoding: control ids give nothing, null
ids the empty text, ids outside the vocabulary the unknown surface, broken byte runs U+FFFD a byte.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, read, schema_of, str_texts

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6          # fixed values: kinds of pieces in a model file
PIECE = 1 << 21          # characters merged at once
MEMO = 400_000           # remembered parts per worker
LONG = 48                # longer parts are merged with a heap
SPAN = 1 << 20           # symbols are below this
NEVER = (1 << 31) - 1

codecs.register_error("each-byte", lambda e: ("�", e.start + 1))


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = raw[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = raw[at:at + size], at + size
        else:
            size = {5: 4, 1: 8}[kind]
            value, at = struct.unpack("<f" if kind == 5 else "<d", raw[at:at + size])[0], at + size
        yield key >> 3, value


def compiled_map(blob: bytes) -> dict[str, str]:
    """Keys and targets of a compiled character map: the size of a double-array trie, its units (32 bit
    each), then the targets, each ended by a zero byte."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, targets = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]

    def step(unit: np.ndarray) -> np.ndarray:         # from a node to the place its children count from
        return (unit >> 10) << ((unit & 512) >> 6)

    out, labels = {}, np.arange(1, 256)
    places, keys = step(units[:1]), [b""]             # the nodes of one depth: children's place, key so far
    while len(keys):
        found = []
        for k in range(0, len(keys), 4096):
            at = places[k:k + 4096, None] ^ labels
            known = np.where(at < len(units), units[np.minimum(at, len(units) - 1)], -1) & 0x800000FF == labels
            node, label = np.nonzero(known)
            found.append((node + k, labels[label], at[node, label]))
        parent, label, at = map(np.concatenate, zip(*found))
        places = at ^ step(units[at])
        keys = [keys[p] + bytes([c]) for p, c in zip(parent.tolist(), label.tolist())]
        ends = units[at] >> 8 & 1 == 1                # a key ends here; its value stands at the children's place
        for i in np.flatnonzero(ends).tolist():
            start = int(units[places[i]] & 0x7FFFFFFF)
            out[keys[i]] = targets[start:targets.index(0, start)]
    return {k.decode(): v.decode() for k, v in out.items()}


class CharMap:
    """Longest-prefix replacement by a compiled map."""

    END = ""

    def __init__(self, entries: dict[str, str]):
        self.trie: dict = {}
        for key, target in entries.items():
            node = self.trie
            for c in key:
                node = node.setdefault(c, {})
            node[self.END] = target
        alone = "".join(map(re.escape, sorted(k for k in entries if len(k) == 1)))
        second = "".join(map(re.escape, sorted({k[1] for k in entries if len(k) > 1})))
        ways = [f"[{alone}]"] * bool(alone) + [f"(?s:.)(?=[{second}])"] * bool(second)
        self.may_begin = re.compile("|".join(ways)) if ways else None

    def runs(self, text: str) -> Iterator[tuple[int, int, str | None]]:
        """(begin, end, target) that cover ``text``; target None: copied as it is."""
        at, free, n = 0, 0, len(text)
        while self.may_begin and (m := self.may_begin.search(text, at)):
            begin = i = m.start()
            node, end, target = self.trie, -1, None
            while i < n and (node := node.get(text[i])) is not None:
                i += 1
                if self.END in node:
                    end, target = i, node[self.END]
            if end < 0:
                at = begin + 1
                continue
            if begin > free:
                yield free, begin, None
            yield begin, end, target
            at = free = end
        if free < n:
            yield free, n, None


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, raw: bytes):
        self.piece: list[str] = []
        score, kind = [], []
        options, charmap = {"type": 1, "bytes": 0, "suffix": 0, "prefix": 1, "trim": 1, "escape": 1, "unk": " ⁇ "}, b""
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                self.piece.append(f[1].decode())
                score.append(f.get(2, 0.0))
                kind.append(f.get(3, NORMAL))
            elif number == 2:
                for n, v in _fields(value):
                    name = {3: "type", 24: "suffix", 35: "bytes", 44: "unk"}.get(n)
                    if name:
                        options[name] = v.decode() if name == "unk" else v
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2:
                        charmap = v
                    elif n in (3, 4, 5):
                        options[{3: "prefix", 4: "trim", 5: "escape"}[n]] = v
        kinds = np.array(kind)
        if options["type"] != 2 or options["suffix"] or not set(kind) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("expected a BPE model without white-space suffixes, user-defined or unused pieces")
        self.prefix, self.trim, self.escape = (bool(options[x]) for x in ("prefix", "trim", "escape"))
        self.map = CharMap(compiled_map(charmap))
        self.space = SPACE if self.escape else " "
        self.size = size = len(self.piece)
        self.unk = kind.index(UNKNOWN)
        self.end = next((i for i, p in enumerate(self.piece) if p == "</s>" and kind[i] == CONTROL), None)
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.piece) if kind[i] == BYTE} if options["bytes"] else {}
        normal = {p: i for i, p in enumerate(self.piece) if kind[i] == NORMAL}
        spare = self.spare = sorted({c for p in normal for c in p} - set(normal))        # inside pieces, no piece themselves
        self.symbol = normal | {c: size + i for i, c in enumerate(spare)}
        order = {s: r for r, s in enumerate(sorted(set(score), reverse=True))}
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}              # (left, right) -> (rank, piece)
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    self.pair[a, b] = (order[score[i]], i)
        keys = np.array([(a * SPAN + b, r, i) for (a, b), (r, i) in self.pair.items()] or [(-1, 0, 0)], np.int64)
        self.pair_key, self.pair_rank, self.pair_id = np.ascontiguousarray(keys[np.argsort(keys[:, 0])].T)
        known = sorted((ord(c), i) for c, i in self.symbol.items() if len(c) == 1)
        self.code, self.code_symbol = (np.array(x, np.int64) for x in zip(*known))
        self.no_symbol = size + len(spare)           # a character that no piece holds
        beside = {p[i:i + 2] for p in normal for i in range(len(p) - 1)}    # characters some piece joins
        if any(b == self.space != a for a, b in beside):
            raise ValueError("a piece holds a space mark after another character")
        alone = [c for c in "\n\t\r" if not any(c in p for p in beside)]    # such characters are parts themselves
        x, s = "".join(map(re.escape, alone)), re.escape(self.space)
        self.parts = re.compile(f"{s}+[^{s}{x}]*|[^{s}{x}]+" + (f"|[{x}]" if x else ""))
        self.memo: dict[str, bytes] = {}
        # tables by id, for spans and decoding; one more entry stands for ids outside the vocabulary
        self.chars = np.array([len(p) if k == NORMAL else 0 for p, k in zip(self.piece, kind)], np.int64)
        self.is_byte, self.value = np.append(kinds == BYTE, False), np.zeros(size + 1, np.int64)
        surface = []
        for i, p in enumerate(self.piece):
            if kind[i] == BYTE:
                self.value[i] = int(p[3:5], 16)
                surface.append(bytes([int(p[3:5], 16)]))
            else:
                surface.append({NORMAL: p.replace(SPACE, " "), CONTROL: "", UNKNOWN: options["unk"]}[kind[i]].encode())
        surface.append(options["unk"].encode())
        self.opens = np.array([p.startswith(SPACE) and k == NORMAL for p, k in zip(self.piece, kind)] + [False])
        self.silent = np.append(kinds == CONTROL, False)
        self.flat = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array(list(map(len, surface)), np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.decimal = [str(i) for i in range(size)]

    # ------------------------------------------------------------------ normalisation
    @staticmethod
    def _byte_offsets(text: str) -> np.ndarray:
        """Byte offset of each character, and of the end."""
        n = len(text)
        if text.isascii():
            return np.arange(n + 1)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        return np.concatenate([[0], np.cumsum(width)])

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, a byte offset in ``text``."""
        offsets = self._byte_offsets(text)
        if not text:
            return "", offsets
        if self.map.may_begin is None:
            out, source, lead = text, np.arange(len(text) + 1), len(text) - len(text.lstrip(" "))
        else:
            parts, places, lead = [], [], 0
            for begin, end, target in self.map.runs(text):
                part = text[begin:end] if target is None else target
                if lead == begin:                     # all before are spaces; so is this, or its beginning
                    lead = end if part == " " else begin + (len(part) - len(part.lstrip(" ")) if target is None else 0)
                parts.append(part)
                places.append(np.arange(begin, end) if target is None else np.full(len(target), begin))
            places.append([len(text)])
            out, source = "".join(parts), np.concatenate(places).astype(np.int64)
        lead = lead if self.trim else 0
        if self.trim:
            out, source = self._single_spaces(out, source)
        if self.escape:
            out = out.replace(" ", SPACE)
        if self.prefix and lead < len(text):
            out, source = self.space + out, np.append(lead, source)
        if self.trim:
            out = out.rstrip(self.space)
        return out, offsets[source[:len(out) + 1]]

    @staticmethod
    def _single_spaces(out: str, source: np.ndarray) -> tuple[str, np.ndarray]:
        """No space at the beginning or after another."""
        blank = np.frombuffer(out.encode("utf-32-le"), np.uint32) == 32
        stay = ~blank | np.append(False, ~blank[:-1])[:len(blank)]
        return re.sub("  +", " ", out.lstrip(" ")), source[np.append(stay, True)]

    # ------------------------------------------------------------------ merging
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * SPAN + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER), self.pair_id[at]

    def _symbols(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.code_symbol[at], self.no_symbol), code

    def _merge_all(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of the normalised text. In each round every part makes its best merge."""
        symbols, code = self._symbols("".join(parts))
        sizes = np.array(list(map(len, parts)), np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)
        place, done = np.arange(len(symbols)), []
        rank, new = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner], new[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            best = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), starts)
            over = best >> 32 == NEVER
            at = best[~over] & 0xFFFFFFFF
            if over.any():                            # these parts are ready
                out = np.repeat(over, np.diff(np.append(starts, len(part))))
                done.append((place[out], symbols[out], part[out]))
                at = (np.cumsum(~out) - 1)[at]
                symbols, part, place, rank, new = (x[~out] for x in (symbols, part, place, rank, new))
                if not len(symbols):
                    break
            symbols[at] = new[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))              # one place went in each part before
            symbols, part, place, rank, new = (x[stay] for x in (symbols, part, place, rank, new))
            rank[at] = NEVER
            right = np.append(part[1:] == part[:-1], False)[at]
            left = np.append(False, part[1:] == part[:-1])[at]
            look = np.concatenate([at[right], at[left] - 1])
            rank[look], new[look] = self._ranks(symbols[look], symbols[look + 1])
        place, symbols, part = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place)
        symbols, part, code = symbols[order], part[order], code[place[order]]
        many = np.bincount(part, minlength=len(parts))
        odd = np.flatnonzero(symbols >= self.size)
        if len(odd):                                  # characters that are no piece
            spelt = [self._spelt(c) for c in code[odd].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[odd] = list(map(len, spelt))
            many = np.bincount(part, weights=times, minlength=len(parts)).astype(np.int64)
            first = np.cumsum(times) - times
            symbols = np.repeat(symbols, times)
            for k, ids in zip(first[odd].tolist(), spelt):
                symbols[k:k + len(ids)] = ids
        flat, ends = symbols.astype("<i4").tobytes(), (4 * np.cumsum(many)).tolist()
        return [flat[i:j] for i, j in zip([0, *ends], ends)]

    def _spelt(self, code: int) -> list[int]:
        return [self.byte_ids[b] for b in chr(code).encode()] if self.byte_ids else [self.unk]

    def _merge_one(self, part: str) -> bytes:
        """Ids of a long part."""
        symbols, _ = self._symbols(part)
        s, out = self._merge_long([x if x != self.no_symbol else c for x, c in zip(symbols.tolist(), part)]), []
        for x in s:
            if isinstance(x, int) and x < self.size:
                out.append(x)
            else:
                out += self._spelt(ord(x if isinstance(x, str) else self.spare[x - self.size]))
        return np.array(out, "<i4").tobytes()

    def _merge_long(self, s: list) -> list:
        pair, n = self.pair, len(s)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(pair[p][0], i, p) for i, p in enumerate(zip(s, s[1:])) if p in pair]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i] if s[i] == p[0] else -1
            if j < 0 or s[j] != p[1]:
                continue                              # one of the two has been merged meanwhile
            s[i], s[j] = pair[p][1], None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (q := (s[left], s[right])) in pair:
                    heapq.heappush(heap, (pair[q][0], left, q))
        return [x for x in s if x is not None]

    def _known(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of the parts; long ones aren't remembered."""
        if len(self.memo) + len(parts) > MEMO:
            self.memo.clear()
        fresh = parts.difference(self.memo)
        short = [p for p in fresh if len(p) <= LONG]
        if short:
            self.memo.update(zip(short, self._merge_all(short)))
        if len(short) == len(fresh):
            return self.memo
        long = {p: self._merge_one(p) for p in fresh if len(p) > LONG}
        return {p: self.memo[p] if len(p) <= LONG else long[p] for p in parts}

    def _cut(self, normal: str) -> Iterator[list[str]]:
        """The parts, about ``PIECE`` characters at a time."""
        at, gap = 0, re.compile(f"(?<!{self.space}){self.space}")
        while at < len(normal):
            end = len(normal)
            if end - at > 2 * PIECE and (cut := gap.search(normal, at + PIECE)):
                end = cut.start()
            yield self.parts.findall(normal, at, end)
            at = end

    def encode_all(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids without the end id, and the byte spans of their pieces: an array of (begin, end)."""
        group, size = [], 0
        for text in texts:
            group.append(self.normalise(text))
            size += len(text)
            if size > PIECE:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[tuple[str, np.ndarray]]):
        if len(group) == 1 and len(group[0][0]) > PIECE:
            normal, origin = group[0]
            out = []
            for parts in self._cut(normal):
                out += map(self._known(set(parts)).__getitem__, parts)
            yield self._spans(b"".join(out), origin)
            return
        split = [self.parts.findall(normal) for normal, _ in group]
        known = self._known(set().union(*split))
        for parts, (_, origin) in zip(split, group):
            yield self._spans(b"".join(map(known.__getitem__, parts)), origin)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return next(self.encode_all([text]))

    def _spans(self, raw: bytes, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(raw, "<i4")
        if not len(ids):
            return ids, np.zeros((0, 2), np.int64)
        size = self.chars[ids]
        bytes_ = self.is_byte[ids]
        if bytes_.any():                              # the last byte of a character holds it
            follows = np.append(bytes_[1:] & (self.value[ids[1:]] & 0xC0 == 0x80), False)
            size = np.where(bytes_, ~follows, size)
        if not self.byte_ids and (unknown := ids == self.unk).any():
            size = np.where(unknown, 1, size)
            again = np.append(False, unknown[1:] & unknown[:-1])            # a run of unknown is one piece
            ids, size = ids[~again], np.add.reduceat(size, np.flatnonzero(~again))
        stop = np.cumsum(size)
        return ids, np.stack([origin[stop - size], origin[stop]], 1)

    # ------------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        ids = np.where((ids < 0) | (ids >= self.size), self.size, ids)
        silent = self.silent[ids]
        cuts = (np.cumsum(~silent)[silent]).tolist()  # control ids end a run of bytes
        ids = ids[~silent]
        if not len(ids):
            return ""
        start, length = self.offset[ids], self.length[ids]
        if self.prefix or self.trim:                  # the first piece loses its space mark, with trim every leading one
            first = self.opens[ids] & (np.arange(len(ids)) == 0)
            if self.trim:
                blank = (length == 1) & self.opens[ids]
                lead = int(np.argmin(blank)) if not blank.all() else len(ids) - 1
                first[:lead + 1] = self.opens[ids[:lead + 1]]
            start, length = start + first, length - first
        return "".join(self._surface(start[i:j], length[i:j]) for i, j in zip([0, *cuts], [*cuts, len(ids)]) if i < j)

    def _surface(self, start: np.ndarray, length: np.ndarray) -> str:
        out = []
        for k in range(0, len(start), PIECE):
            n, s = length[k:k + PIECE], start[k:k + PIECE]
            to = np.cumsum(n)
            out.append(self.flat[np.repeat(s - (to - n), n) + np.arange(to[-1])].tobytes())
        return b"".join(out).decode("utf-8", "each-byte")


_PIECES: dict[str, Pieces] = {}


def pieces(raw: bytes) -> Pieces:
    """One model per Python process (workers are reused between tasks)."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _PIECES:
        _PIECES.clear()
        _PIECES[key] = Pieces(raw)
    return _PIECES[key]


def default_model() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _shared(df: DataFrame, model: str | None):
    with open(model or default_model(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           end_id: bool = True, with_pieces: bool = True, with_text: bool = False) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256, spans_sha256`` for every row: digests of the decimal ids
    joined by one space, of the decoded text, and of the spans (begin and end as little-endian 64-bit integers).
    With ``with_pieces`` also ``pieces``: an array of id, begin, end (bytes of the source, end exclusive)."""
    shared = _shared(docs, model)
    piece = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("begin", T.LongType()),
                          T.StructField("end", T.LongType())])
    extra = [("pieces", T.ArrayType(piece))] * with_pieces + [("decoded", T.StringType())] * with_text
    schema = schema_of(docs, id_col, ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
                       ("decoded_sha256", T.StringType()), ("spans_sha256", T.StringType()), *extra)

    def digest(raw: bytes) -> str:
        return hashlib.sha256(raw).hexdigest()

    def run(batches):
        p = pieces(shared.value)
        for batch in batches:
            columns = [[] for _ in range(4 + len(extra))]
            for ids, spans in p.encode_all(str_texts(batch.column(1))):
                if end_id and p.end is not None:
                    ids = np.append(ids, np.int32(p.end))
                    last = spans[-1:, 1:] if len(spans) else np.zeros((1, 1), np.int64)
                    spans = np.concatenate([spans, np.repeat(last, 2, 1)])
                decoded = p.decode(ids)
                row = [len(ids), digest(" ".join(map(p.decimal.__getitem__, ids.tolist())).encode()),
                       digest(decoded.encode()), digest(spans.astype("<i8").tobytes())]
                if with_pieces:
                    row.append([{"id": i, "begin": b, "end": e} for i, (b, e) in zip(ids.tolist(), spans.tolist())])
                if with_text:
                    row.append(decoded)
                for column, value in zip(columns, row):
                    column.append(value)
            yield batch_of(schema, [batch.column(0), *columns])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``id_col, text`` from a column of ids (null: empty text)."""
    shared = _shared(tokens, model)
    schema = schema_of(tokens, id_col, ("text", T.StringType()))

    def run(batches):
        p = pieces(shared.value)
        for batch in batches:
            texts = [p.decode(np.array([i for i in v.as_py() or [] if i is not None], np.int64)) for v in batch.column(1)]
            yield batch_of(schema, [batch.column(0), texts])

    return tokens.select(id_col, ids_col).mapInArrow(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents", "doc_id", "text"), with_pieces=False)
