"""Words, lemmas, stop words and filters of whole texts (N11 to N17), worked out once a word.

``text.lemmatize_tokens`` and the filters behind it run for every token; a task
here keeps what became of each word it met, and a batch of texts only looks up
the words that it holds.  The rules are the same.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .lexicon import DOUBLED_STEM, LEMMA_EXCEPTIONS, LEMMA_RULES, SILENT_E_STEM, VERB_FORM, VERB_STEM

#: Bytes of text that are worked on at a time, and words whose outcome a task keeps.
BLOCK_BYTES = 2 << 20
KEPT_WORDS = 200_000


def lemma(word: str) -> str:
    """N13 of one word of a-z: the dictionary, then the suffix rules."""
    if word in LEMMA_EXCEPTIONS:
        return LEMMA_EXCEPTIONS[word]
    if word.endswith(("s", "ied")):
        for pattern, template in LEMMA_RULES:
            if found := re.search(pattern, word):
                return template.replace("{1}", found[1])
        return word
    if not word.endswith(("ed", "ing")):
        return word
    stem = word[:-2] if word.endswith("d") else word[:-3]
    if not (re.search(VERB_FORM, word) and re.search(VERB_STEM, stem)):
        return word
    if re.search(DOUBLED_STEM, stem):
        return stem[:-1]
    return stem + "e" if re.search(SILENT_E_STEM, stem) else stem


#: Every byte that is no letter of a-z, and so every byte of another character, as a space.
LETTERS = np.array([b if ord("a") <= b <= ord("z") else ord(" ") for b in range(256)], dtype=np.uint8)


def _letters(texts: pa.Array) -> pa.Array:
    texts = pa.concat_arrays([texts, texts.slice(0, 0)])  # buffers of a slice alone
    valid, ends, data = texts.buffers()
    if data is not None:
        data = pa.py_buffer(LETTERS[np.frombuffer(data, dtype=np.uint8)])
    return pa.Array.from_buffers(texts.type, len(texts), [valid, ends, data], offset=texts.offset)


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes together, or of one row."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield first, last
        first = last


def kept_lemmas(text: Column | str, min_len: int, stopwords: list[str]) -> Column:
    """The lemmas of a text's runs of a-z that are no stop words and long enough, joined by one space."""
    stops = frozenset(stopwords)

    def outcome(word):
        out = lemma(word)
        return out if out not in stops and len(out) >= min_len and out.isalpha() else None

    def looked_up(texts, known):
        lists = pc.split_pattern(_letters(texts), " ")
        of = np.repeat(np.arange(len(texts), dtype=np.int32), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        for word in words:
            if word not in known:
                known[word] = outcome(word)
        lemmas = pa.array([known[word] for word in words], pa.string())
        stay = np.asarray(lemmas.is_valid())[coded.indices.to_numpy()]
        ends = np.searchsorted(of[stay], np.arange(len(texts) + 1)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), lemmas.take(coded.indices.filter(pa.array(stay)))), " ")
        return pc.if_else(texts.is_valid(), joined, pa.scalar(None, pa.string()))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict = {}
        for texts in batches:
            parts = []
            for first, last in slices(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64), BLOCK_BYTES):
                if len(known) > KEPT_WORDS:
                    known.clear()
                parts.append(looked_up(texts.slice(first, last - first), known))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    # a filter on the lemmas would be pushed below them, with a run of its own
    return F.arrow_udf(run, StringType()).asNondeterministic()(text)
