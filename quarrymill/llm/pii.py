"""Personal data: base patterns, candidate generators and boosted trees, with DataFrame and SQL functions only.

Base spans come from four patterns, leftmost and without overlap per kind, and always stay. High-recall generators then
propose further, overlapping spans: written-out or spaced e-mail addresses, numbers in phone, account or identity
form without a plus sign, colon-separated hardware and network addresses, account numbers in international form. Trees
boosted on a labelled set of written examples (`examples`; bounded by its parameter, generated by rules, never taken
from the corpus) score each candidate by its format and by the characters around it; a threshold for each generator,
calibrated on the part of the examples that was held out, selects what is redacted. Candidates that touch a base span,
or a better candidate, give way. Trees become one SQL expression, so scoring runs in the same pass as the patterns.

The patterns are those of the contract in a form that never backtracks: a match can only start where a run of its
characters starts or the last match ended, and repetitions never give back what they took.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm import boosting
from quarrymill.llm.common import carried, restored

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Generators: kind of the span, pattern. Their spans may overlap each other and the base spans. Their bounds are those of the
# things they look for: 64 characters of a mailbox, 63 of a host's label and four labels after it, 7 to 15 digits of a
# number, 34 characters of an account. Longer runs are no candidates; plain addresses of any length are base spans.
GENERATORS = (
    ("email", r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\x20at\x20)\x20?[A-Z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Z0-9-]{2,63}+){1,4}"),
    ("phone", r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])"),
    ("ip", r"(?i)(?<![0-9A-F:])(?:[0-9A-F]{1,4}:){5,7}+[0-9A-F]{1,4}(?![0-9A-F:])"),
    ("account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
)
FEATURES = ("generator", "length", "digits", "letters", "gaps", "groups", "luhn", "cue", "joined", "cased", "written")
WRITTEN = r"(?i)@.*\x20dot\x20|[(\[]at[)\]]|[(\[]dot[)\]]|\x20at\x20.*\x20dot\x20|\x20@\x20\S+$"  # an address that was spelt out
# Words that announce personal data, in the languages at hand; fixed values.
CUES = "account|call|card|cell|contact|email|e-mail|fax|host|iban|mac|mail|mobile|number|phone|reach|ssn|social|tel|telefon|telefono|courriel|konto"
BEFORE = 24  # characters of context
CUT = 4096  # code points of a piece of text

EXAMPLES = 4000


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def luhn_of(digits: str) -> bool:
    doubled = [int(d) if i % 2 == 0 else int(d) * 2 % 10 + int(d) // 5 for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step: Callable[[Column, Column], Column], zero: Column) -> Column:
    """The results of step (associative, with zero) over all values up to each one. Goes by blocks of about the square
    root of their number, so that n values cost about n ** 1.5 short steps and no array is copied for each."""
    fold = lambda part: F.aggregate(part, zero, step)

    def by_blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1), lambda b: F.slice(v, b * width + 1, width))
        one = lambda block, before: F.transform(block, lambda _, i: step(before, fold(F.slice(block, F.lit(1), i + 1))))
        return let(blocks, lambda bs: let(F.transform(bs, fold), lambda sums: F.flatten(F.transform(bs, lambda block, n: let(fold(F.slice(sums, F.lit(1), n)), lambda before: one(block, before))))))

    return F.when(F.size(values) > 0, let(values, by_blocks)).otherwise(F.array().cast("array<int>"))


def running_sum(values: Column) -> Column:
    return running(values, lambda a, x: a + x, F.lit(0))


def running_max(values: Column) -> Column:
    return running(values, lambda a, x: F.greatest(a, x), F.lit(-1))


def text_blocks(text: Column) -> Column:
    """text in pieces of CUT code points, for `cut_out`."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / CUT).cast("int")), lambda b: F.substring(text, b * CUT + 1, F.lit(CUT)))


def cut_out(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from start to end (exclusive) without a walk over all of the text before them."""
    first = F.floor(start / CUT).cast("int")
    return F.substring(F.array_join(F.slice(blocks, first + 1, F.floor(end / CUT).cast("int") - first + 1), ""), start - first * CUT + 1, F.greatest(end - start, F.lit(0)))


def located(found: Column) -> Column:
    """Spans (kind, start, end, value, generator) from a struct of kind, generator, the matches and the pieces of text
    between them."""
    matches, pieces = found["matches"], found["pieces"]
    lengths = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p))
    span = lambda m, end: F.struct(found["kind"].alias("kind"), (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value"), found["generator"].alias("generator"))
    return F.zip_with(matches, running_sum(lengths), span)


def apart(candidates: Column, base: Column) -> Column:
    """The candidates that touch no base span. Base starts and candidates' ends in one order: a candidate is touched if a
    base span that starts before its end reaches beyond its start."""
    starts = F.transform(base, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("kind"), s["end"].alias("reach"), F.lit(-1).alias("n")))
    ends = F.transform(candidates, lambda s, n: F.struct(s["end"].alias("at"), F.lit(0).alias("kind"), F.lit(-1).alias("reach"), n.alias("n")))

    def reaches(events: Column) -> Column:
        reached = F.zip_with(events, running_max(F.transform(events, lambda e: e["reach"])), lambda e, r: F.struct(e["n"].alias("n"), r.alias("reach")))
        return F.transform(F.array_sort(F.filter(reached, lambda e: e["n"] >= 0)), lambda e: e["reach"])

    pairs = F.zip_with(candidates, let(F.array_sort(F.concat(starts, ends)), reaches), lambda c, reach: F.struct(c.alias("c"), reach.alias("reach")))
    return F.when((F.size(base) > 0) & (F.size(candidates) > 0), F.transform(F.filter(pairs, lambda p: p["reach"] <= p["c"]["start"]), lambda p: p["c"])).otherwise(candidates)


def best_of(candidates: Column) -> Column:
    """The candidates (start, end, kind, odds, value) that no better one touches: by odds, then the earlier, then the
    lesser kind. In order of start they fall into clusters that nothing crosses; each is compared within its own, so the
    cost goes with the clusters' sizes."""

    def beaten(c: Column, o: Column) -> Column:
        first = (o["start"] < c["start"]) | ((o["start"] == c["start"]) & (o["kind"] < c["kind"]))
        return (o["start"] < c["end"]) & (c["start"] < o["end"]) & ((o["odds"] > c["odds"]) | ((o["odds"] == c["odds"]) & first))

    def clusters(s: Column) -> Column:
        return let(running_max(F.transform(s, lambda c: c["end"])), lambda reach: F.filter(F.transform(s, lambda c, n: F.when((n == 0) | (c["start"] >= F.get(reach, n - 1)), n).otherwise(-1)), lambda n: n >= 0))

    def within(s: Column, firsts: Column) -> Column:
        members = F.transform(firsts, lambda n, i: F.slice(s, n + 1, F.coalesce(F.get(firsts, i + 1), F.size(s)) - n))
        return F.flatten(F.transform(members, lambda own: F.filter(own, lambda c: ~F.exists(own, lambda o: beaten(c, o)))))

    return let(F.array_sort(candidates), lambda s: F.when(F.size(s) > 1, let(clusters(s), lambda firsts: within(s, firsts))).otherwise(s))


def valid(span: Column) -> Column:
    """Whether a base match of its kind holds."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    is_kind = lambda kind: span["kind"] == KINDS.index(kind)
    return F.when(is_kind("ip"), span["value"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")).when(is_kind("card"), luhn(digits)).when(is_kind("phone"), F.length(digits).between(8, 15)).otherwise(True)


def of_kind(number: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == number


def features_sql(generator: int | str) -> list[str]:
    """The features of a candidate struct c (value, before, after) as SQL, in the order of FEATURES; generator is a number
    or an expression."""
    digits = "regexp_replace(c.value, '[^0-9]', '')"
    return [
        str(generator),
        "length(c.value)",
        f"length({digits})",
        "length(regexp_replace(c.value, '[^A-Za-z]', ''))",
        "length(regexp_replace(c.value, '[A-Za-z0-9]', ''))",
        "regexp_count(c.value, '[0-9]+')",
        f"IF(length({digits}) > 0 AND aggregate(transform(split(reverse({digits}), '(?<=.)(?=.)'), (d, i) -> IF(i % 2 = 0, int(d), int(d) * 2 % 10 + int(d) div 5)), 0L, (a, b) -> a + b) % 10 = 0, 1, 0)",
        f"IF(c.before RLIKE '(?i)(?<![a-z])(?:{CUES})(?![a-z])', 1, 0)",
        "IF(c.before RLIKE '[A-Za-z0-9=:/#_\"]$' OR c.after RLIKE '^[A-Za-z0-9=:/#_\"]', 1, 0)",
        "IF(c.value RLIKE '[A-Z]', 1, 0)",
        "IF(c.value RLIKE '" + WRITTEN.replace("\\", "\\\\") + "', 1, 0)",
    ]


def features_of(generator: int, value: str, before: str, after: str) -> list[float]:
    """The same features of a written example."""
    digits = re.sub("[^0-9]", "", value)
    edge = '[A-Za-z0-9=:/#_"]'
    return [generator, len(value), len(digits), len(re.sub("[^A-Za-z]", "", value)), len(re.sub("[A-Za-z0-9]", "", value)), len(re.findall("[0-9]+", value)), float(bool(digits) and luhn_of(digits)), float(bool(re.search(rf"(?i)(?<![a-z])(?:{CUES})(?![a-z])", before))), float(bool(re.search(edge + "$", before) or re.match(edge, after))), float(bool(re.search("[A-Z]", value))), float(bool(re.search(WRITTEN, value)))]


def examples(count: int = EXAMPLES, seed: int = 20260801) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of `count` written examples, a fixed mixture of personal data and of lookalikes."""
    rng = random.Random(seed)
    word = lambda n=6: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, n)))
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cues = CUES.split("|")
    rows, labels = [], []
    for n in range(count):
        generator, good = n % len(GENERATORS), (n // len(GENERATORS)) % 2 == 0
        cue = rng.random() < (0.8 if good else 0.15)
        before, after = f"{word()} {rng.choice(cues) if cue else word()}{rng.choice([' ', ': '])}", rng.choice([" ", ".", ",", "", "\n"])
        if generator == 0:
            if good:
                at, dot = rng.choice([(" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" @ ", "."), ("@", " dot ")])
                value = f"{word(9)}{rng.choice(['', '.' + word(), digit(2)])}{at}{word(9)}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}"
            else:
                value = rng.choice([f"{word(9).title()} at {word(9)}. {word(9).title()}. {word().title()}", f"{word(9)} at {word(9)}. {word(9)}", f"{word(9)} at {word(9)}.{word(4)}.{word(4)}", f"{word(9)} at {word(9)} .{word()}", f"{word()} at {word()}.{word(8)}", f"{word(8)}@ {word()}. {word()}"])
                before = f"{word()} {word()} "
        elif generator == 1:
            if good:
                value = rng.choice([f"({digit(3)}) {digit(3)}-{digit(4)}", f"{digit(3)}-{digit(3)}-{digit(4)}", f"{digit(3)}.{digit(3)}.{digit(4)}", f"{digit(3)}-{digit(2)}-{digit(4)}", f"0{digit(3)} {digit(3)} {digit(4)}"])
            else:
                value = rng.choice([digit(rng.randint(7, 15)), f"{digit(4)}-{digit(2)}-{digit(2)}", f"{digit(4)}.{digit(2)}.{digit(2)}", " ".join(digit(rng.randint(1, 2)) for _ in range(6)), f"{digit(2)}.{digit(3)}.{digit(3)}", digit(16)[:15], f"{digit(3)}.{digit(3)}.{digit(3)}.{digit(2)}"])
                before = f"{word()} {word()} " if rng.random() < 0.9 else before
                if rng.random() < 0.4:
                    before, after = before[:-1] + rng.choice(["=", "#", '"', "/", ":"]), rng.choice(['"', "/", "_", " "])
        elif generator == 2:
            block = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
            value = ":".join(block(2) for _ in range(6)) if rng.random() < 0.5 else ":".join(block(4) for _ in range(8))
            if not good:
                value = ":".join(digit(rng.choice([1, 2])) for _ in range(rng.choice([6, 7])))
        else:
            value = f"{rng.choice(['DE', 'FR', 'ES', 'GB', 'NL'])}{digit(2)} {' '.join(digit(4) for _ in range(rng.randint(3, 5)))}{rng.choice(['', ' ' + digit(2)])}"
            if not good:
                value = rng.choice(["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(2)) + digit(2) + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(12))])
                before, after = before[:-1] + rng.choice(["=", "#", '"', "/", "_"]), '"'
        rows.append(features_of(generator, value, before[-BEFORE:], after))
        labels.append(good)
    return np.array(rows, np.float64), np.array(labels, np.float64)


@cache
def model(count: int = EXAMPLES, precision: float = 0.995) -> tuple[list, tuple[float, ...]]:
    """Trees fitted on three quarters of the examples, and for each generator the lowest log odds at which the other
    quarter is right in at least `precision` of what it selects."""
    x, y = examples(count)
    held = np.arange(len(x)) // (2 * len(GENERATORS)) % 4 == 3
    trees = boosting.fit(x[~held], y[~held])
    thresholds = []
    for generator in range(len(GENERATORS)):
        own = held & (x[:, 0] == generator)
        odds = boosting.score(trees, x[own])
        order = np.argsort(-odds, kind="stable")
        right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        thresholds.append(float(odds[order][good[-1]]) if len(good) else float("inf"))
    return trees, tuple(max(t, 0.0) - 1e-6 for t in thresholds)  # SQL has nine digits of each value


def with_spans(docs: DataFrame) -> DataFrame:
    """docs with _text (null as empty), _base and _spans: arrays of (kind, start, end, value) in code points, end
    exclusive, sorted by kind (a number: place in KINDS, then account) and start. _spans holds all, base ones included."""
    out = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    none = F.array().cast("array<string>")
    guard = {"email": F.contains("_text", F.lit("@")), "phone": F.contains("_text", F.lit("+"))}
    patterns = {f"b{i}": (BASE[k], guard.get(k)) for i, k in enumerate(KINDS)} | {f"g{i}": (p, None) for i, (_, p) in enumerate(GENERATORS)}
    # has the text any digit, any sign for `at`? most have not, and skip the patterns
    out = out.withColumn("_digits", F.col("_text").rlike("[0-9]")).withColumn("_at", F.col("_text").rlike(r"(?i)@|[\x20(\[]at[\x20)\]]"))
    cheap = {"b1": F.col("_digits"), "b2": F.col("_digits"), "g0": F.col("_at"), "g1": F.col("_digits"), "g2": F.contains("_text", F.lit(":")), "g3": F.col("_digits")}
    found = {}
    for name, (pattern, test) in patterns.items():
        test = cheap.get(name) if test is None else test
        found[f"_m{name}"] = F.when(test, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none)
    out = out.withColumns(found)
    out = out.withColumns({f"_p{name}": F.when(F.size(f"_m{name}") > 0, F.split("_text", pattern, -1)).otherwise(none) for name, (pattern, _) in patterns.items()})
    trees, thresholds = model()
    kinds = {k: i for i, k in enumerate((*KINDS, "account"))}
    source = lambda name, kind, generator: F.struct(F.lit(kinds[kind]).alias("kind"), F.lit(generator).alias("generator"), F.col(f"_m{name}").alias("matches"), F.col(f"_p{name}").alias("pieces"))
    sources = F.array(*(source(f"b{i}", k, -1) for i, k in enumerate(KINDS)), *(source(f"g{i}", k, i) for i, (k, _) in enumerate(GENERATORS)))
    spans = "array<struct<kind:int,start:int,end:int,value:string,generator:int>>"
    # all patterns go through one expression; texts without a match skip it
    out = out.withColumn("_all", F.when(F.size(F.concat(*(f"_m{name}" for name in patterns))) > 0, F.flatten(F.transform(F.filter(sources, lambda x: F.size(x["matches"]) > 0), located))).otherwise(F.array().cast(spans)))
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    out = out.withColumn("_base", F.transform(F.filter("_all", lambda s: (s["generator"] < 0) & valid(s)), plain))
    out = out.withColumn("_c", apart(F.filter("_all", lambda s: s["generator"] >= 0), F.col("_base")))
    out = out.withColumn("_blocks", F.when(F.size("_c") > 0, text_blocks(F.col("_text"))))
    context = F.transform("_c", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["generator"].alias("generator"), cut_out(F.col("_blocks"), F.greatest(s["start"] - BEFORE, F.lit(0)), s["start"]).alias("before"), cut_out(F.col("_blocks"), s["end"], s["end"] + 1).alias("after")))
    out = out.withColumn("_x", F.when(F.size("_c") > 0, context))
    features, odds = ", ".join(f"double({x})" for x in features_sql("c.generator")), boosting.as_sql(trees, [f"f[{n}]" for n in range(len(FEATURES))])
    least = f"array({', '.join(f'{(float(t) if np.isfinite(t) else 1e300)!r}D' for t in thresholds)})"
    judged = f"transform(_x, c -> struct(c.start AS start, c.end AS end, c.kind AS kind, c.value AS value, transform(array(array({features})), f -> {odds})[0] AS odds, c.generator AS generator))"
    selected = f"transform(filter({judged}, c -> c.odds >= {least}[c.generator]), c -> struct(c.start AS start, c.end AS end, c.kind AS kind, c.value AS value, c.odds AS odds))"
    out = out.withColumn("_added", F.when(F.size("_c") > 0, best_of(F.expr(selected))).otherwise(F.array().cast("array<struct<start:int,end:int,kind:int,value:string,odds:double>>")))
    out = out.withColumn("_spans", F.when(F.size("_added") > 0, F.array_sort(F.concat("_base", F.transform("_added", plain)))).otherwise(F.col("_base")))
    return out.select(*docs.columns, "_text", "_base", "_spans")


def described(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, "account")))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of docs.

    Null text counts as empty. Rows that repeat give equal results; doc_id may be null. Other columns are left aside.
    An empty table gives an empty result. One pass, no shuffle; the cost of a text with n matches grows about as n ** 1.5.
    """
    out = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    counts = [F.size(F.filter("_base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(described("_base"), 256).alias("base_sha256"), described("_spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span in text replaced by its kind in brackets; overlapping spans become one, named by the first.

    Texts without spans, nulls among them, stay as they are; n_chars, if there is such a column, follows the text. Rows
    that repeat give equal rows; all other columns are carried apart, so none can clash. An empty table stays empty.
    """
    out = with_spans(carried(docs, F.col("text").cast("string").alias("text")))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS, "account")))

    def merged(spans: Column, reach: Column) -> Column:
        """The first of each group of overlapping spans, with what the spans before it reach."""
        marked = F.transform(spans, lambda s, n: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.when(n == 0, 0).otherwise(F.get(reach, n - 1)).alias("before")))
        return F.filter(marked, lambda s: s["start"] >= s["before"])

    def rewritten(firsts: Column, last: Column) -> Column:
        parts = F.transform(firsts, lambda s: F.concat(cut_out(F.col("_cut"), s["before"], s["start"]), F.get(names, s["kind"])))
        return F.concat(F.array_join(parts, ""), cut_out(F.col("_cut"), last, F.length("_text")))

    by_start = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = let(by_start, lambda spans: let(running_max(F.transform(spans, lambda s: s["end"])), lambda reach: rewritten(merged(spans, reach), F.element_at(reach, -1))))
    changed = F.size("_spans") > 0
    out = out.withColumn("_cut", F.when(changed, text_blocks(F.col("_text"))))
    return restored(out.withColumn("_new", F.when(changed, text)), docs, F.col("_new"), changed)
