"""Quality rules: shape of the words, and how well public vocabularies fit a text.

A tokeniser's fertility shows what prose looks like to it: characters per token,
the share of characters that it can only spell in bytes, and the entropy of its
tokens. Each script has bands for these; a text outside of them is rejected.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bronzeway.llm.common import row_mapper, with_fields
from bronzeway.llm.spm import BYTE, MODEL, NORMAL, read_model

#: Public vocabulary of many languages, on every machine of the sandbox.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Splits a text before the merges of that vocabulary (fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Band:
    """What a text of a script may have; each bound is included.

    ``spread`` is the entropy of the tokens over the largest that so many tokens
    can have (the logarithm of their number), in blocks of up to BLOCK_TOKENS of
    them, over all blocks of the text: over a whole text it falls with length, as
    a language's entropy stays while the logarithm grows.
    """

    chars_per_token: tuple[float, float]
    byte_share: float
    spread: float


#: By language where the rows tell it, else by script. The four languages were
#: set from labelled rows: each bound lies outside of what good texts had.
BANDS = {
    "en": Band((1.98, 6.0), 0.05, 0.60),
    "de": Band((1.98, 6.0), 0.05, 0.60),
    "fr": Band((1.92, 6.0), 0.05, 0.60),
    "es": Band((1.92, 6.0), 0.05, 0.60),
    "latin": Band((1.85, 8.0), 0.05, 0.45),
    "cyrillic": Band((1.0, 8.0), 0.10, 0.45),
    "greek": Band((0.6, 8.0), 0.20, 0.45),
    "other": Band((0.3, 8.0), 1.0, 0.40),
}
#: Every band is wider by so many tokens' share of the text: the measures of a short text
#: say little, those of a long one are exact. Set from labelled rows, as the bands are.
WIDER_TOKENS = 6
#: Tokens of a block whose entropy is measured; longer texts have equal blocks.
BLOCK_TOKENS = 512


def script_of(text: str) -> str:
    """Script of most letters: latin, cyrillic, greek or other (also without letters)."""
    if text.isascii():
        return "latin" if any(c.isalpha() for c in set(text)) else "other"
    counts = Counter()
    for c in set(text):
        if c.isalpha():
            point = ord(c)
            if point < 0x250 or 0x1E00 <= point < 0x1F00:
                name = "latin"
            elif 0x370 <= point < 0x400 or 0x1F00 <= point < 0x2000:
                name = "greek"
            elif 0x400 <= point < 0x530:
                name = "cyrillic"
            else:
                name = "other"
            counts[name] += text.count(c)
    return max(sorted(counts), key=counts.__getitem__, default="other")


def repeated_words(words: list[str], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of so many words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(runs)
    if len(counts) == n:
        return 0
    starts = np.fromiter((counts[r] > 1 for r in runs), bool, n)
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_measures(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """(words, their characters, symbols, repeated lines, repeated words, failed)."""
    text = text or ""
    words = WORD.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    n_symbols = sum(map(text.count, SYMBOLS))
    return len(words), sum(map(len, words)), n_symbols, repeated_lines, n_repeat, failed


@lru_cache(maxsize=2)
def _vocabularies(ranks: bytes, model: bytes):
    import tiktoken
    from sentencepiece import sentencepiece_model_pb2

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}
    )
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    spelled = {c for p in proto.pieces if p.type not in (BYTE, 2, 3) for c in p.piece}
    assert NORMAL in {p.type for p in proto.pieces}
    return encoding, frozenset(spelled | {" "})


def entropy_spread(tokens: np.ndarray) -> float:
    """Entropy of the blocks over the largest that they can have, by their tokens."""
    n = len(tokens)
    if n < 2:
        return 1.0
    entropy = largest = 0.0
    for block in np.array_split(tokens, -(-n // BLOCK_TOKENS)):
        share = np.unique(block, return_counts=True)[1] / len(block)
        entropy -= len(block) * float((share * np.log2(share)).sum())
        largest += len(block) * float(np.log2(len(block)))
    return entropy / largest


def fertility(encoding, spelled, text: str | None) -> tuple[int, float, float, float]:
    """(tokens, characters per token, share of byte-spelled characters, spread).

    Without text: no tokens and zeros. A single token has a spread of one.
    """
    if not text:
        return 0, 0.0, 0.0, 0.0
    tokens = np.asarray(encoding.encode_ordinary(text), np.int32)
    n = len(tokens)
    bytes_only = sum(map(text.count, set(text) - spelled))
    return n, len(text) / n, bytes_only / len(text), entropy_spread(tokens)


def judge(
    text: str | None, lang: str | None, n_tokens: int, chars: float, bytes_only: float, spread: float
) -> bool:
    if not n_tokens:
        return True
    band = BANDS.get(lang) or BANDS[script_of(text)]
    slack = WIDER_TOKENS / n_tokens
    low, high = band.chars_per_token
    fits = low * (1 - slack) <= chars <= high * (1 + slack)
    return fits and bytes_only <= band.byte_share + slack and spread >= band.spread - slack


MEASURES = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "n_tokens": "bigint",
    "chars_per_token": "double",
    "byte_share": "double",
    "spread": "double",
    "kept": "boolean",
}


def measure(
    docs: DataFrame,
    text: str = "text",
    lang: str | None = "lang",
    ranks: str = RANKS,
    model: str = MODEL,
) -> DataFrame:
    """Add the measures and ``kept`` to every row; one pass and no shuffle.

    Words, lines and tokens are those of the whole text. A NULL or empty text
    has zeros, fails the base rules and is not kept. Repeated rows are measured
    each; input columns of the measures' names are replaced. ``kept`` is false
    if ``base_failed``, else true inside the band of the row's language, or of the
    text's script where ``lang`` is None, NULL or not listed; bands are the wider the
    fewer tokens a text has. Texts of any length are measured whole; no rows give none.
    """
    keep = [c for c in docs.columns if c not in MEASURES]
    out = with_fields(docs.select(*keep), **MEASURES)
    shipped = docs.sparkSession.sparkContext.broadcast((read_model(ranks), read_model(model)))

    def per_row(encoding, spelled, value, language=None):
        base = base_measures(value)
        fit = fertility(encoding, spelled, value)
        return (*base, *fit, not base[-1] and judge(value, language, *fit))

    kinds = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    made = pa.schema([(name, kinds[kind]) for name, kind in MEASURES.items()])
    run = row_mapper(per_row, [text, lang] if lang else [text], made, keep, lambda: _vocabularies(*shipped.value))
    return docs.mapInArrow(run, out)
