"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge can only join two neighbouring bytes ``a b`` if some vocabulary token holds ``a b`` inside.
So a 256 x 256 table of the byte pairs that do occur inside tokens marks certain cuts: between any
other two bytes no merge ever happens. Each pre-token is cut there, the fragments are merged
independently (and remembered, as fragments repeat across a corpus), and the ids are concatenated;
this equals merging the whole pre-token.

Row-local: one pass over the texts, no shuffle. The vocabulary (a file of bounded size, its path is
a parameter) is read once on the driver and broadcast.

Cases: a null text counts as empty and gives no tokens; strings of special tokens inside a text
become their id, as the library does by default; very long texts are pre-tokenised in pieces of
``PIECE`` pre-tokens and long fragments are merged with a heap, O(n log n); repeated rows and null
ids give one result row each; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inkstream.llm.common import batch_of, schema_of, str_texts

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space beside other white space; a space between two characters that are none.
NEXT_TO_SPACE = [x for c in map(chr, range(0x3001)) if c.isspace() and c != " " for x in (" " + c, c + " ")]
SINGLE = re.compile(r"(?<=\S) (?=\S)")
PIECE = 1 << 21          # characters, pre-tokens or ids handled at once
MEMO = 500_000           # remembered words per worker
ID_SPAN = 1 << 24        # ids are below this
NEVER = (1 << 31) - 1
LONG = 64                # bytes from which a fragment is merged with a heap


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file (JSON text of the tokenizers library)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges")):
            raise ValueError("expected a byte-level BPE vocabulary without normaliser or prefix space")
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        vocab = model["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(of_letter[c] for c in tok) for tok, i in vocab.items()}
        self.byte_id = [vocab[c] for c in byte_letters()]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((vocab[a], vocab[b]), (r, vocab[a + b]))
        #: inside[a * 256 + b] is 1 if some token holds byte a directly before byte b
        inside = np.zeros(65536, np.uint8)
        for tok in self.bytes_of.values():
            raw = np.frombuffer(tok, np.uint8).astype(np.int32)
            inside[raw[:-1] * 256 + raw[1:]] = 1
        self.inside = inside
        self.special: dict[str, int] = {}
        for t in spec.get("added_tokens", []):
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip"):
                raise ValueError("added tokens that strip or match whole words are not supported")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pre = regex.compile(PRE_TOKEN)
        self.memo: dict[str, bytes] = {}            # ids of what stands between two single spaces
        pairs = np.array([(x * ID_SPAN + y, r, i) for (x, y), (r, i) in self.rank.items()], np.int64)
        pairs = pairs[np.argsort(pairs[:, 0])] if len(pairs) else np.zeros((1, 3), np.int64) - 1
        self.pair_key, self.pair_rank, self.pair_id = np.ascontiguousarray(pairs.T)
        self.pair_rank, self.pair_id = self.pair_rank.astype(np.int32), self.pair_id.astype(np.int32)
        self.byte_ids = np.array(self.byte_id, np.int32)
        left, right = np.divmod(np.arange(65536), 256)           # the first round: a table of byte pairs
        self.byte_rank, self.byte_new = self._ranks(self.byte_ids[left], self.byte_ids[right])
        size = max(self.bytes_of) + 1
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.length = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.offset = np.cumsum(self.length) - self.length

    # ------------------------------------------------------------------ merging
    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * ID_SPAN + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        known = self.pair_key[at] == key
        return np.where(known, self.pair_rank[at], np.int32(NEVER)), self.pair_id[at]

    def merge_all(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of each pre-token."""
        lengths = np.array(list(map(len, tokens)), np.int64)
        return self._merge(b"".join(tokens), np.cumsum(lengths), np.cumsum(lengths)) if tokens else []

    def _merge(self, raw: bytes, token_ends: np.ndarray, group_ends: np.ndarray) -> list[bytes]:
        """Ids of each group of pre-tokens that lie end to end in ``raw``. All are cut at the forced
        boundaries, and in each round every fragment makes its first merge (lowest rank, leftmost),
        until none is left."""
        raw = np.frombuffer(raw, np.uint8).astype(np.int32)
        n = len(raw)
        first = np.zeros(n + 1, bool)                            # a fragment starts here
        first[0] = first[token_ends] = True
        if n > 1:
            first[1:-1] |= self.inside[raw[:-1] * 256 + raw[1:]] == 0
        first = first[:-1]
        ids, place = self.byte_ids[raw], np.arange(n, dtype=np.int32)
        rank, new = np.full(n, NEVER, np.int32), np.zeros(n, np.int32)
        if n > 1:
            inner = np.flatnonzero(~first[1:])
            pair = raw[inner] * 256 + raw[inner + 1]
            rank[inner], new[inner] = self.byte_rank[pair], self.byte_new[pair]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        done_ids, done_place = [], []
        if (sizes > LONG).any():                                 # long fragments: with a heap
            for k in np.flatnonzero(sizes > LONG).tolist():
                i, j = int(starts[k]), int(starts[k] + sizes[k])
                got, kept = self._merge_long(ids[i:j].tolist())
                done_ids.append(np.array(got, np.int32))
                done_place.append(np.array(kept, np.int32) + i)
            keep = np.repeat(sizes <= LONG, sizes)
            ids, place, first, rank, new = (x[keep] for x in (ids, place, first, rank, new))
        while len(ids):
            starts = np.flatnonzero(first)
            key = np.minimum.reduceat((rank.astype(np.int64) << 32) + np.arange(len(ids)), starts)
            over = key >> 32 == NEVER
            if over.any():                                       # these fragments are ready
                out = np.repeat(over, np.diff(np.append(starts, len(ids))))
                done_ids.append(ids[out])
                done_place.append(place[out])
                out = ~out
                shift = np.cumsum(out, dtype=np.int32) - 1
                ids, place, first, rank, new = (x[out] for x in (ids, place, first, rank, new))
                at = shift[(key[~over] & 0xFFFFFFFF)]
                if not len(ids):
                    break
            else:
                at = key & 0xFFFFFFFF
            ids[at] = new[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))                         # one place went in each fragment before
            ids, place, first, rank, new = (x[stay] for x in (ids, place, first, rank, new))
            follows = np.ones(len(at), bool)
            inside = at + 1 < len(ids)
            follows[inside], follows[~inside] = ~first[at[inside] + 1], False
            rank[at] = NEVER
            look = np.concatenate([at[follows], at[~first[at]] - 1])
            rank[look], new[look] = self._ranks(ids[look], ids[look + 1])
        ids, place = np.concatenate([*done_ids, ids]), np.concatenate([*done_place, place])
        by_place = np.full(n, -1, np.int32)
        by_place[place] = ids
        held = by_place >= 0
        cut = np.append(0, np.cumsum(held))[group_ends].tolist()
        flat = by_place[held].astype("<u4").tobytes()
        return [flat[4 * i:4 * j] for i, j in zip([0, *cut], cut)]

    def _merge_long(self, s: list[int]) -> tuple[list[int], list[int]]:
        """Ids and the place where each begins."""
        n = len(s)
        after, before, rank = [*range(1, n), -1], [-1, *range(n - 1)], self.rank
        heap = [(*rank[p], i, *p) for i, p in enumerate(zip(s, s[1:])) if p in rank]
        heap = [(r, i, new, a, b) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i] if s[i] == a else -1
            if j < 0 or s[j] != b:
                continue  # one of the two has been merged meanwhile
            s[i], s[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (p := (new, s[k])) in rank:
                    heapq.heappush(heap, (rank[p][0], i, rank[p][1], *p))
            if (h := before[i]) >= 0 and (p := (s[h], new)) in rank:
                heapq.heappush(heap, (rank[p][0], h, rank[p][1], *p))
        kept = [i for i, x in enumerate(s) if x >= 0]
        return [s[i] for i in kept], kept

    # ------------------------------------------------------------------ whole texts
    def _learn(self, parts: set[str]) -> None:
        """Put the ids of ``parts`` (each follows a space and holds none beside other characters
        than white space) into the memo. Laid end to end they are pre-tokenised in one go."""
        if len(self.memo) + len(parts) > MEMO:
            self.memo.clear()
        plain = [p for p in parts if " " not in p]
        if plain:
            found = [t.encode() for t in self.pre.findall(" " + " ".join(plain))]
            ends = np.cumsum([len(t) for t in found])
            opens = np.array([t[:1] == b" " for t in found])     # only a part's first token has a space
            group = np.append((ends - [len(t) for t in found])[opens][1:], ends[-1])
            self.memo.update(zip(plain, self._merge(b"".join(found), ends, group)))
        for p in parts - set(plain) if len(plain) < len(parts) else ():
            self.memo[p] = b"".join(self.merge_all([t.encode() for t in self.pre.findall(" " + p)]))

    def _head(self, text: str) -> bytes:
        """Ids of a text in which no cut at a single space is used."""
        found, out = self.pre.finditer(text), []
        while part := [m[0] for m in islice(found, PIECE)]:
            names = list(set(part))
            ids = dict(zip(names, self.merge_all([t.encode() for t in names])))
            out.append(b"".join(map(ids.__getitem__, part)))
        return b"".join(out)

    def _plain(self, texts: list[str]) -> list[bytes]:
        """A single space between two other characters always starts a pre-token and nothing before
        it looks beyond it, so a text is cut there first and the parts are remembered whole."""
        split = [t.split(" ") if not self._odd(t) else SINGLE.split(t) for t in texts]
        opening = [s.pop(0) for s in split]
        found = [self.pre.findall(o) if len(o) <= 256 else [] for o in opening]
        known = iter(self.merge_all([t.encode() for f in found for t in f]))
        heads = [b"".join(islice(known, len(f))) if f or not o else self._head(o) for f, o in zip(found, opening)]
        parts = set().union(*split)
        long = {p for p in parts if len(p) > 256}
        if new := parts.difference(self.memo, long):
            self._learn(new)
            if len(new) < len(parts) and (new := parts.difference(self.memo, long)):   # the memo was emptied
                self._learn(new)
        get = self.memo.__getitem__
        if long:
            get = lambda p: self._head(" " + p) if p in long else self.memo[p]
        return [h + b"".join(map(get, s)) for h, s in zip(heads, split)]

    @staticmethod
    def _odd(text: str) -> bool:
        """Some space stands at an end or beside other white space."""
        return (text[:1].isspace() or text[-1:].isspace() or "  " in text
                or any(a in text for a in NEXT_TO_SPACE))

    def _pieces(self, text: str):
        """``text`` in pieces of about ``PIECE`` characters, cut before a single space; special
        tokens stand alone (as ids)."""
        at = 0
        for m in (self.split.finditer(text) if self.split else ()):
            yield from self._cut(text, at, m.start())
            yield self.special[m[0]]
            at = m.end()
        yield from self._cut(text, at, len(text))

    @staticmethod
    def _cut(text: str, at: int, end: int):
        while end - at > 2 * PIECE and (m := SINGLE.search(text, at + PIECE, end)):
            yield text[at:m.start()]
            at = m.start()
        if end > at:
            yield text[at:end]

    def encode_all(self, texts) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, in order; texts are taken in
        groups of bounded size."""
        group, size = [], 0
        for text in texts:
            if len(text) > PIECE or self.split and any(name in text for name in self.special):
                yield from self._plain(group)
                group, size = [], 0
                yield b"".join(struct.pack("<I", p) if isinstance(p, int) else self._plain([p])[0]
                               for p in self._pieces(text))
                continue
            group.append(text)
            size += len(text)
            if size > PIECE:
                yield from self._plain(group)
                group, size = [], 0
        yield from self._plain(group)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        """The text of ids, rebuilt from the bytes of each token."""
        out = []
        every = np.frombuffer(ids, "<u4").astype(np.int64)
        for k in range(0, len(every), PIECE):
            part = every[k:k + PIECE]
            n = self.length[part]
            to = np.cumsum(n)
            out.append(self.flat[np.repeat(self.offset[part] - (to - n), n) + np.arange(to[-1])].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(text: str) -> Codec:
    """One codec per vocabulary and Python process (workers are reused between tasks)."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(text)
    return _CODECS[key]


def default_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str | None = None, with_ids: bool = True, with_text: bool = False) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` (+ ``ids``, + ``decoded``) for every row."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    extra = [("ids", T.ArrayType(T.IntegerType()))] * with_ids + [("decoded", T.StringType())] * with_text
    schema = schema_of(docs, id_col, ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()),
                       ("decoded_sha256", T.StringType()), *extra)

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            n, sha, back, ids, texts = [], [], [], [], []
            for raw in c.encode_all(str_texts(batch.column(1))):
                decoded = c.decode(raw)
                n.append(len(raw) // 4)
                sha.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(raw, "<u4").astype(np.int32))
                if with_text:
                    texts.append(decoded)
            yield batch_of(schema, [batch.column(0), n, sha, back, *[ids] * with_ids, *[texts] * with_text])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids",
           vocabulary: str | None = None) -> DataFrame:
    """``id_col, text`` from a column of ids (null ids: empty text)."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(f.read())
    schema = schema_of(tokens, id_col, ("text", T.StringType()))

    def run(batches):
        c = codec(shared.value)
        for batch in batches:
            yield batch_of(schema, [batch.column(0), [
                c.decode(np.array(v.as_py() or [], "<u4").tobytes()) for v in batch.column(1)]])

    return tokens.select(id_col, ids_col).mapInArrow(run, schema)


def op7(spark, sf_dir: str) -> DataFrame:
    from inkstream.llm.common import read
    return encode(read(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False)
