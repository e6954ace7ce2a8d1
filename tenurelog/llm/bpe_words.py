"""The ids of whole texts under a byte-level BPE, each distinct word encoded once per worker.

The pre-tokenizer of a byte-level BPE splits before a single blank between two
visible ASCII characters, and merges never cross such a place. So a text is cut
there, equal pieces are encoded once and looked up after that.
"""

from __future__ import annotations

import json

import numpy as np

from . import tokens as tk

CACHE = 1_000_000  # distinct pieces a worker remembers; beyond that it starts over

# Fixed value: how a byte-level BPE with ``use_regex`` splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def require_byte_level(definition: str) -> dict:
    """The parsed definition; ValueError unless it is a byte-level BPE that splits a text by its own pattern."""
    parsed = json.loads(definition)
    model, split = parsed["model"], parsed.get("pre_tokenizer") or {}
    plain = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if (
        model.get("type") != "BPE"
        or any(model.get(k) for k in plain)
        or split.get("type") != "ByteLevel"
        or not split.get("use_regex", True)
        or split.get("add_prefix_space", True)
        or parsed.get("normalizer")
    ):
        raise ValueError("the definition is no byte-level BPE with the pattern that this encoder knows")
    odd = [t for t in parsed.get("added_tokens") or [] if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"]]
    if odd:
        raise ValueError("added tokens that take blanks along are not known to this encoder")
    return parsed


def _gather(source: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches ``source[at : at + n]`` one after another."""
    total = int(n.sum())
    shift = np.repeat(at - (np.cumsum(n) - n), n)
    return source[np.arange(total) + shift]


def _token_bytes(tokenizer, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes each id stands for, by the byte-to-character rule of byte-level BPE.

    Printable Latin-1 characters stand for their own byte, the other bytes for
    the characters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = []
    for i in range(size):
        if i in special:
            out.append(special[i].encode())
        else:
            out.append(bytes(byte_of[c] for c in tokenizer.id_to_token(i) or ""))
    at = np.cumsum([0, *map(len, out)])
    return np.frombuffer(b"".join(out), np.uint8), at


def firm_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, whether the pre-tokenizer splits before it for certain."""
    firm = np.zeros(len(data), bool)
    if len(data) > 2:
        visible = (data > 32) & (data < 127)
        firm[1:-1] = (data[1:-1] == 32) & visible[:-2] & visible[2:]
    for near in (0, -1):  # a neighbour in another text proves nothing
        at = offsets[1:-1] + near
        firm[at[(at >= 0) & (at < len(data))]] = False
    firm[offsets[:-1][offsets[:-1] < len(data)]] = True
    return firm


class ByteBpe:
    """One vocabulary in one worker."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        parsed = require_byte_level(definition)
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.bytes, self.byte_at = _token_bytes(self.library, size)
        self.fast = self._by_rank(parsed)

    def _by_rank(self, parsed: dict):
        """A faster encoder of the same ids, if the ids follow the order of the merges; else None."""
        vocabulary, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if made != list(range(256, 256 + len(made))) or len(vocabulary) != 256 + len(made):
            return None
        import tiktoken

        special = {t["content"]: t["id"] for t in parsed.get("added_tokens") or []}
        data, at = self.bytes.tobytes(), self.byte_at.tolist()
        ranks = {data[at[i] : at[i + 1]]: i for i in range(256 + len(made))}
        return tiktoken.Encoding("definition", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode_plain(self, text: str) -> list[int]:
        if self.fast is None:
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, end to end."""
        return _gather(self.bytes, self.byte_at[ids], self.byte_at[ids + 1] - self.byte_at[ids])


class WordEncoder(ByteBpe):
    """With the pieces encoded so far."""

    def __init__(self, definition: str):
        super().__init__(definition)
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces end to end and their numbers.

        Pieces that begin with a blank before a visible character and end with
        one are put together and encoded in one call: they split there for certain.
        """
        visible = (data > 32) & (data < 127)
        second = visible[np.minimum(starts + 1, len(data) - 1)] & (ends - starts > 1)
        whole = (data[starts] == 32) & second & visible[ends - 1]
        order = np.concatenate([np.flatnonzero(whole), np.flatnonzero(~whole)])
        starts, ends = starts[order], ends[order]
        joined = int(whole.sum())
        flat: list[np.ndarray] = []
        n = np.zeros(len(order), np.int64)
        if joined:
            text = _gather(data, starts[:joined], (ends - starts)[:joined]).tobytes().decode()
            ids = np.array(self.encode_plain(text), np.int64)
            close = np.cumsum((ends - starts)[:joined])
            after = np.cumsum(self.byte_at[ids + 1] - self.byte_at[ids])
            upto = np.searchsorted(after, close, "left") + 1
            if not np.array_equal(after[upto - 1], close):
                raise AssertionError("a token crosses a place where the text splits")
            n[:joined] = np.diff(upto, prepend=0)
            flat.append(ids)
        blob = data.tobytes()
        for i in range(joined, len(order)):
            ids = np.array(self.encode_plain(blob[starts[i] : ends[i]].decode()), np.int64)
            n[i] = len(ids)
            flat.append(ids)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        ids = np.concatenate(flat).astype(np.uint32)
        at = np.cumsum(n) - n
        return _gather(ids, at[back], n[back]), n[back]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's ids begin, one more than there are texts."""
        starts = np.flatnonzero(firm_places(data, offsets))
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        if len(self.key) > CACHE:
            self.forget()
        key = tk.span_hashes(data, starts, ends)
        distinct, first, which = np.unique(key, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.key, distinct)
        known = np.zeros(len(distinct), bool)
        inside = slot < len(self.key)
        known[inside] = self.key[slot[inside]] == distinct[inside]
        if not known.all():
            new = first[~known]
            flat, n = self._encode_new(data, starts[new], ends[new])
            place = slot[~known]
            self.key = np.insert(self.key, place, distinct[~known])
            self.at = np.insert(self.at, place, len(self.ids) + np.cumsum(n) - n)
            self.n = np.insert(self.n, place, n)
            self.ids = np.concatenate([self.ids, flat])
            slot = np.searchsorted(self.key, distinct)
        slot = slot[which]
        n = self.n[slot]
        ids = _gather(self.ids, self.at[slot], n)
        before = np.concatenate([[0], np.cumsum(n)])
        return ids, before[np.searchsorted(starts, offsets)]


_loaded: dict[str, WordEncoder] = {}


def encoder_of(definition) -> WordEncoder:
    """The encoder of a broadcast definition, one per worker."""
    text = definition.value
    if text not in _loaded:
        _loaded.clear()
        _loaded[text] = WordEncoder(text)
    return _loaded[text]
