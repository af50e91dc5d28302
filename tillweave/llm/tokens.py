"""Exact token ids of whole texts, with each different word encoded once per task."""

from __future__ import annotations

import hashlib
import re
import string
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

#: Words in each of the two generations of the memory; older ones are forgotten, which only costs time.
MEMORY = 350_000
#: Characters of the longest word that is remembered.
LONGEST = 64
_SPACE = re.compile("[ \t\r\n]")
#: A full stop or comma at a word's end that belongs to a longer run of marks or to a marker of the vocabulary.
_JOINED = r"[^\pL\pN\s][.,][ \n]"
#: Characters of text that are numbered together.
AT_ONCE = 1 << 21


class WordTokenizer:
    """Ids of a lower-casing word-level BPE, equal to the library's on the whole text.

    The vocabulary drops white space before it merges, so a text's ids are those of
    its words one after another. Words of letters are lowered and merged by the same
    model without the text preparation they don't need, all that a text lacks in one
    call, and their tail of punctuation is looked up; other words go through the whole
    tokenizer. ``encode(texts)`` gives one ``bytes`` of little-endian unsigned 32-bit
    ids per text.
    """

    def __init__(self, path: str):
        self.rust = Tokenizer.from_file(path)
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.rust.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, number in vocabulary.items():
            self.ends[number] = piece.endswith("</w>")
        self.words: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _plain(self, text: str) -> bytes:
        return np.array(self.rust.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _fill(self, missing: set[str]) -> None:
        words, letters = self.words, self.letters
        old_words, old_letters = self.older
        split, fresh = [], set()
        for word in missing:
            if word in old_words:
                words[word] = old_words[word]
                continue
            core = word.rstrip(string.punctuation)
            if core.isalpha() and len(word) <= LONGEST and (core.isascii() or (
                    unicodedata.is_normalized("NFC", word) and "Σ" not in core and "İ" not in core)):
                tail, core = word[len(core):], core.lower()
                split.append((word, core, tail))
                if core not in letters:
                    if core in old_letters:
                        letters[core] = old_letters[core]
                    else:
                        fresh.add(core)
                if tail and tail not in words:
                    words[tail] = self._plain(tail)
            else:
                words[word] = self._plain(word)
        if fresh:
            names = list(fresh)
            ids = np.array(self.merges.encode_batch_fast([" ".join(names)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(names):
                raw, at = ids.tobytes(), 0
                for name, stop in zip(names, (stops * 4).tolist()):
                    letters[name] = raw[at:stop]
                    at = stop
            else:
                letters.update((name, self._plain(name)) for name in names)
        for word, core, tail in split:
            words[word] = letters[core] + words[tail] if tail else letters[core]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        start = size = 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= AT_ONCE or k == len(texts) - 1:
                out += self._encode(texts[start:k + 1])
                start, size = k + 1, 0
        pa.default_memory_pool().release_unused()
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        """The words of all texts are numbered together; what a word gives is looked up once and dealt out by number."""
        joined = pc.match_substring_regex(pa.array(texts, pa.large_string()), _JOINED)
        ready = []
        for text, whole in zip(texts, joined.to_pylist()):
            if not whole:  # then a sentence's marks are pieces of their own anyway
                text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ")
            ready.append(_SPACE.sub(" ", text) if "\t" in text or "\r" in text else text.replace("\n", " "))
        split = pc.split_pattern(pa.array(ready, pa.large_string()), " ")
        numbered = split.values.dictionary_encode()
        parts = numbered.dictionary.to_pylist()
        missing = {w for w in parts if w not in self.words}
        if missing:
            if len(self.words) + len(missing) > MEMORY:
                self.older = (self.words, self.letters)
                self.words, self.letters = {"": b""}, {}
                missing = set(parts) - {""}
            self._fill(missing)
        ids = [self.words[w] for w in parts]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        store, of = np.frombuffer(b"".join(ids), "<u4"), numbered.indices.to_numpy()
        first = (np.cumsum(lengths) - lengths)[of]
        lengths = lengths[of]
        ends = np.cumsum(lengths)
        line = store[np.repeat(first - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        return [line[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the kept columns, n_words (ASCII white space), n_ids, n_bytes and text_key (SHA-256 of the text).

    A null text counts nothing and has a null key, as if no other text were like it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            cols = [pa.array([len(b.split()) for b in raw], pa.int64()),
                    pa.array([len(i) // 4 for i in words.encode([t or "" for t in texts])], pa.int64()),
                    pa.array([len(b) for b in raw], pa.int64()),
                    pa.array([None if t is None else hashlib.sha256(b).hexdigest() for t, b in zip(texts, raw)], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *cols], names=[
                *batch.schema.names[1:], "n_words", "n_ids", "n_bytes", "text_key"])

    kept = [F.col(c) for c in (id_col, *keep)]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (id_col, *keep))
    return docs.select(F.col(text_col).cast("string"), *kept).mapInArrow(
        run, fields + ", n_words long, n_ids long, n_bytes long, text_key string")
