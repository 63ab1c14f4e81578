"""Text functions of the prompt rules as Spark columns."""

from __future__ import annotations

import html
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions import vocab

STRIP = " ,.;\t\r\n"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(value: Column) -> Column:
    """The same value, which the optimizer does not copy into each expression and filter that reads it. It knows that
    rand() itself is never below 0 and would drop a bare comparison."""
    return F.when(F.rand(0) + 1 > 0, value)


@F.udf(T.StringType(), useArrow=False)
def _unescape(text: str | None) -> str | None:
    """Not by Arrow: its batches are of 10,000 texts whatever their length, pickled ones of 100."""
    return None if text is None else html.unescape(text)


def let(value: Column, result: Callable[[Column], Column]) -> Column:
    """result(value), with value computed once however often result reads it."""
    return F.element_at(F.transform(F.array(value), result), 1)


#: The only letters beyond ASCII that match ASCII letters where case folds.
FOLDS = "ſKİı"


def fold(text: Column) -> Column:
    """Lower case, with every letter that matches an ASCII letter where case folds as that letter."""
    return F.lower(F.when(reduce(lambda a, b: a | b, (F.contains(text, F.lit(c)) for c in FOLDS)), F.translate(text, FOLDS, "skii")).otherwise(text))


def words_of(text: Column | str) -> Column:
    """The different words of a text, case folded, for `tags.has`."""
    return F.array_distinct(F.split(fold(col(text)), r"(?U)\W+"))


def unescape(text: Column | str) -> Column:
    """HTML entities resolved. Python sees only texts that hold `&` (others are sent as null); null stays null."""
    text = col(text)
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def clean_prompt(text: Column | str, entities: bool = True) -> Column:
    """The prompt without attachments, size hints, options and surplus blanks. Null counts as empty. `entities=False`
    skips the unescaping, for sources that hold none, so that the plan needs no Python."""
    out = F.coalesce(col(text), F.lit(""))
    out = unescape(out) if entities else out
    for pattern in (vocab.ATTACHMENT, vocab.ASPECT, vocab.OPTION, vocab.NEGATED, vocab.COMMAND, r"\s+"):
        out = F.regexp_replace(out, F.lit(vocab.FLAGS + pattern), F.lit(" "))
    return F.btrim(out, F.lit(STRIP))


def word_count(text: Column | str) -> Column:
    """Words between runs of white space; null has none."""
    return F.regexp_count(F.coalesce(col(text), F.lit("")), F.lit(r"(?U)\S+")).cast("long")


def prompt_hash(text: Column | str) -> Column:
    """The first 16 hex digits of SHA-1 of the lower-cased text."""
    return F.substring(F.sha1(F.lower(col(text))), 1, 16)


def tolerant_double(text: Column | str) -> Column:
    """The number that text spells, 0 for null, empty or anything else. `nan` and `inf` are numbers."""
    text = F.trim(col(text).cast("string"))
    plain = text.rlike(r"(?i)^[+-]?(?:[0-9]+\.?[0-9]*(?:e[+-]?[0-9]+)?|\.[0-9]+(?:e[+-]?[0-9]+)?|nan|inf|infinity)$")
    return F.coalesce(F.when(plain, text.try_cast("double")), F.lit(0.0))


def length_bucket(text: Column | str) -> Column:
    return let(word_count(text), lambda n: F.when(n < 16, "short").when(n <= 40, "medium").otherwise("long"))


def sanitize_name(text: Column | str, longest: int = 120) -> Column:
    """Only letters, digits, `-`, `_` and `.`; no `.` or `_` at the ends; `worker` for nothing."""
    out = F.substring(F.btrim(F.regexp_replace(F.coalesce(col(text), F.lit("")), r"[^\p{L}\p{N}._-]", "_"), F.lit("._")), 1, longest)
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("worker"))


def stable_int(text: Column | str) -> Column:
    """The first 12 hex digits of SHA-1 as a number."""
    return F.conv(F.substring(F.sha1(col(text)), 1, 12), 16, 10).cast("long")


def hash_order(seed: int, key: Column | str) -> Column:
    """The sort key of all sampling: MD5 of seed and key, so that results need no random state."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))


def hash_pick(seed: int, key: Column | str, slot: str, n: int | Column) -> Column:
    """A number from 0 to n - 1 that seed, key and slot decide."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string"), F.lit(f":{slot}"))), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(n) if isinstance(n, int) else n)


def row_id(prefix: str, split: Column | str, index: Column | str) -> Column:
    return F.format_string(f"{prefix}_%s_%08d", F.lit(split) if isinstance(split, str) else split, col(index))


def scrub_no_text(text: Column | str) -> Column:
    """Without clauses that ask for no visible text."""
    out = F.regexp_replace(col(text), F.lit(vocab.FLAGS + vocab.NO_TEXT_SENTENCE), F.lit(""))
    return F.btrim(F.regexp_replace(out, F.lit(vocab.FLAGS + vocab.NO_TEXT_INLINE), F.lit("")))


def lineage(*fields: Column | str) -> Column:
    """The non-empty fields, a line each."""
    return F.concat_ws("\n", *(F.nullif(col(f), F.lit("")) for f in fields))


def iso_time(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def split_seed(seed: int, split: str) -> int:
    return seed + 1009 * sum(n * ord(c) for n, c in enumerate(split, 1))


def pool_count(target: int, factor: float = 1.25, extra: int = 50) -> int:
    return 0 if target <= 0 else max(target, -int(-target * factor // 1), target + extra)


def normalize_url(url: str) -> str:
    url = url.rstrip("/")
    return url if url.endswith("/chat/completions") else url + ("" if url.endswith("/v1") else "/v1") + "/chat/completions"


def first_value(config: dict, *keys: str) -> str:
    """The first value under keys that is not empty, as text."""
    return next((str(config[k]) for k in keys if config.get(k)), "")


def config_value(document: Column | str, *keys: str) -> Column:
    """`first_value` for a column of JSON documents: the first value under keys that is not empty, '' if there is none.
    As there, false, 0 and null count as empty."""
    found = (F.get_json_object(col(document), f"$.{key}") for key in keys)
    return F.coalesce(*(F.when(~value.isin("", "false", "0", "0.0", "[]", "{}"), value) for value in found), F.lit(""))


def to_frame(values: Column | str) -> Column:
    """Samples from -1 to 1 as whole numbers from 0 to 255, clamped and rounded half to even; null samples stay null."""
    return F.transform(col(values), lambda x: F.when(x.isNotNull(), F.bround((F.least(F.greatest(x.cast("double"), F.lit(-1.0)), F.lit(1.0)) + 1.0) * 127.5).cast("int")))
