"""SentencePiece encoding and decoding by vectorised merge rounds.

The model's pieces become a sorted table of symbol pairs with the rank of their merge.
A batch's unseen words (a run of word marks and what follows up to the next mark; no
piece has a mark after another character, so no merge crosses words) are laid out as one
flat array of symbols. Each round finds every word's smallest pair rank by a segmented
minimum, merges there, leftmost first, and compacts the arrays, until no word has a pair
that merges. Where a merge could make a pair of smaller rank than its own, a word merges
its leftmost place only in that round; so the result equals the library's, which takes
the best pair, leftmost among equals, one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from persona_engine.llm.memory import release_memory

MARK = "▁"
#: A worker's cache of encoded words is emptied beyond this many (bounded memory; results don't depend on it).
CACHE_WORDS = 100_000
#: Texts whose words are encoded together.
GROUP_TEXTS = 256
_INF = np.int64(1) << 40


class PieceTable:
    """Merge ranks of a sentencepiece BPE model with byte fallback.

    Raises ValueError for a model of another kind (normalisation rules, no byte
    fallback, pieces with a word mark after another character).
    """

    def __init__(self, model_file: str):
        import sentencepiece as spm

        sp = spm.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.end_id = sp.eos_id()
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if sp.encode("ﬁ  Å") and sp.decode(sp.encode("ﬁ  Å")) != "ﬁ  Å":
            raise ValueError("the model normalises its input")
        if any(sp.is_unknown(int(b)) for b in self.byte_id):
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{MARK}]{MARK}", pieces[i]) for i in plain):
            raise ValueError("a piece has a word mark after another character")
        self.id_of = {pieces[i]: i for i in plain}
        # symbols: the pieces, then characters that occur only inside pieces, then one for all other characters
        self.symbol = dict(self.id_of)
        for p in list(self.id_of):
            for ch in p:
                self.symbol.setdefault(ch, size + len(self.symbol))
        self.size = max([size, *self.symbol.values()]) + 2
        score = {i: sp.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted({score[i] for i in plain}, reverse=True))}
        rank = {i: order[score[i]] for i in plain}
        pairs = []
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs.append((a * self.size + b, rank[i], i))
        pairs.sort()
        self.key = np.array([x[0] for x in pairs], np.int64)
        self.rank = np.array([x[1] for x in pairs], np.int64)
        self.made = np.array([x[2] for x in pairs], np.int64)
        # a rank is careful if other pairs share it or a piece made by it takes part in a merge of no larger rank
        best = np.full(self.size, _INF)
        np.minimum.at(best, self.key // self.size, self.rank)
        np.minimum.at(best, self.key % self.size, self.rank)
        by_rank: dict[int, set] = {}
        for _, r, i in pairs:
            by_rank.setdefault(r, set()).add(i)
        self.careful = np.array([len(by_rank.get(r, ())) > 1 or any(best[i] <= r for i in by_rank.get(r, ()))
                                 for r in range(len(order) + 1)])
        self.text_of = {i: p.replace(MARK, " ").encode() for p, i in self.id_of.items()}
        self.text_of.update({int(b): bytes([k]) for k, b in enumerate(self.byte_id)})
        self.known = np.zeros(self.size, bool)
        self.known[plain] = True
        self.text_size = np.zeros(size, np.int64)
        for i, t in self.text_of.items():
            self.text_size[i] = len(t)
        decimal = [str(i).encode() for i in range(size)]
        self.width = np.array([len(t) for t in decimal])
        most = int(self.width.max()) + 1
        self.digits = np.frombuffer(b"".join(t.ljust(most) for t in decimal), np.uint8).reshape(-1, most)     # a space follows each

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made piece of each pair (infinite where the pair never merges)."""
        k = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
        hit = self.key[at] == k
        return np.where(hit, self.rank[at], _INF), np.where(hit, self.made[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each word has (each is a run of word marks with what follows, not empty)."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        other = self.size - 1
        lengths = np.array([len(w) for w in words])
        flat = "".join(words)
        codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        distinct, at = np.unique(codes, return_inverse=True)
        sym = np.array([self.symbol.get(chr(c), other) for c in distinct], np.int64)[at]
        char = codes.astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def ranks(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            r, m = np.full(len(i), _INF), np.full(len(i), -1)
            ok = i + 1 < len(sym)
            ok[ok] = word[i[ok]] == word[i[ok] + 1]
            r[ok], m[ok] = self.pair_rank(sym[i[ok]], sym[i[ok] + 1])
            return r, m

        pr, pm = ranks(np.arange(len(sym)))
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(start, len(word)))
            low = np.minimum.reduceat(pr, start)
            if (low >= _INF).any():  # finished words leave
                out = np.repeat(low >= _INF, size)
                done.append((word[out], sym[out], char[out]))
                sym, char, word, pr, pm = (x[~out] for x in (sym, char, word, pr, pm))
                continue
            here = np.flatnonzero(pr == np.repeat(low, size))
            w = word[here]
            first = np.concatenate([[True], w[1:] != w[:-1]])
            # of places that touch, every second one from the left
            run = np.concatenate([[True], (here[1:] != here[:-1] + 1) | first[1:]])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))
            take = (np.arange(len(here)) - begin) % 2 == 0
            take &= first | ~self.careful[pr[here]]
            here = here[take]
            sym[here] = pm[here]
            keep = np.ones(len(sym), bool)
            keep[here + 1] = False
            moved = np.cumsum(keep) - 1
            sym, char, word, pr, pm = (x[keep] for x in (sym, char, word, pr, pm))
            changed = moved[here]
            changed = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
            pr[changed], pm[changed] = ranks(changed)
        word, sym, char = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, sym, char = word[order], sym[order], char[order]
        # a character that is no piece becomes one id for each of its bytes
        plain = self.known[sym]
        n_ids = np.ones(len(sym), np.int64)
        odd = np.flatnonzero(~plain)
        data = [chr(c).encode() for c in char[odd].tolist()]
        n_ids[odd] = [len(x) for x in data]
        ids = np.repeat(sym, n_ids)
        if len(odd):
            ids[np.repeat(~plain, n_ids)] = self.byte_id[np.frombuffer(b"".join(data), np.uint8)]
        return ids, np.bincount(word, n_ids, len(words)).astype(np.int64)

    def id_texts(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Ids of each word (``sizes`` of them, in order) as decimal text."""
        width = self.width[ids]
        flat = self.digits[ids][np.arange(self.digits.shape[1])[None, :] <= width[:, None]].tobytes().decode("ascii")
        ends = np.concatenate([[0], np.cumsum(width + 1)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [flat[lo:hi - 1] for lo, hi in zip(ends[:-1], ends[1:])]

    def decode_words(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Text of each word's ids; its word marks are spaces. Bytes that are no UTF-8 become U+FFFD."""
        flat = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.text_size[ids])])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        if flat.isascii():
            text = flat.decode("ascii")
            return [text[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])]
        return [flat[lo:hi].decode("utf-8", "replace") for lo, hi in zip(ends[:-1], ends[1:])]


_ODD = re.compile(" +[^ ]*")


def split_words(text: str) -> list[str]:
    """Words of a text without their first word mark; further marks are spaces at their start."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return [w[1:] for w in _ODD.findall(" " + text)]


class Encoder:
    """Encodes whole texts, keeping what it has found for words seen lately.

    Two generations are kept: words in use move to the younger one, and when that is full
    it becomes the older one.
    """

    def __init__(self, model_file: str):
        self.table = PieceTable(model_file)
        self.young: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def learn(self, words: Iterable[str]) -> None:
        """Has all these words in the younger generation."""
        new = []
        for w in words:
            if w not in self.young:
                found = self.old.get(w)
                if found is None:
                    new.append(w)
                else:
                    self.young[w] = found
        ids, sizes = self.table.encode_words([MARK + w.replace(" ", MARK) for w in new])
        self.young.update(zip(new, zip(self.table.id_texts(ids, sizes), self.table.decode_words(ids, sizes))))

    def group(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """Ids as decimal text and the decoded text, for each text."""
        split = [split_words(t or "") for t in texts]
        if len(self.young) > CACHE_WORDS // 2:
            self.young, self.old = {}, self.young
        self.learn(set().union(*split))
        end = str(self.table.end_id)
        for words in split:
            found = [self.young[w] for w in words]
            yield " ".join([x[0] for x in found] + [end]), "".join([x[1] for x in found])[1:]


_encoders: dict[str, Encoder] = {}


def encode_documents(docs: DataFrame, model_file: str, keep_ids: bool = False) -> DataFrame:
    """Encode and decode each document's whole text; one row per input row.

    Columns: doc_id, n_tokens (ids, the end id included), ids_sha256, decoded_sha256;
    with ``keep_ids`` also ids (array of int) and decoded (string). Extra columns of
    ``docs`` are not read, so their names can't clash.

    Null or empty text: the end id alone, decoded as the empty text. A null doc_id stays
    null; repeated rows give repeated rows; an empty table gives an empty result. Texts
    are never cut; a task holds one Arrow batch and a bounded word cache.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoders.setdefault(model_file, None) or Encoder(model_file)
        _encoders[model_file] = enc
        for batch in batches:
            n, a, b, ids, texts = [], [], [], [], []
            column = batch.column(1)
            for lo in range(0, batch.num_rows, GROUP_TEXTS):
                for x, text in enc.group(column.slice(lo, GROUP_TEXTS).to_pylist()):
                    n.append(x.count(" ") + 1)
                    a.append(hashlib.sha256(x.encode()).hexdigest())
                    b.append(hashlib.sha256(text.encode()).hexdigest())
                    if keep_ids:
                        ids.append(np.array(x.split(" "), np.int32))
                        texts.append(text)
            out = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                out += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)
        enc.forget()       # the worker lives on
        release_memory()

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, schema)
