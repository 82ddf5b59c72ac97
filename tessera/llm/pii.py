"""Personal data by candidate gradient boosting, with DataFrame functions only.

Generators of high recall propose spans, which may overlap. Spans that a checked pattern confirms (an
address, a number with the right check digits or parts) are the base and always stay. Boosted trees over
format and context features score what else is proposed; a proposal is added where its calibrated precision
reaches the wanted one.

There are no labels, so the trees learn from what is certain: base spans are positive, and what has the look
but fails its check (wrong check digits, parts out of range, an address without a domain, a date) is negative.
Proposals themselves are neither, so how common they are says nothing against them, and both classes weigh
the same, so how common negatives are doesn't either. Features leave out what only the base can have (the +
of a number, the @ of an address), and the thresholds are set on documents that the trees weren't fitted on.
All features are bits, so the whole corpus enters as counts of bit patterns, a table of bounded size; the
trees become one SQL expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
# A match of these patterns always begins where its run of characters does, or where the match before it
# ended; saying so keeps long runs without a match from being tried from every character. Repeats are
# possessive where nothing after them could need what they took: Java matches a greedy group by recursion,
# so a domain of many thousand parts would overflow the stack and end the executor.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MORE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\})\x20?[a-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[a-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:[.\x20_/-]{1,2}[0-9]{4}){3}(?![0-9])",
    # not a part of a longer run of groups, as a card number is
    "phone": (
        r"(?<![0-9+])(?<![0-9][./-])(?<![0-9]{4}\x20)(?:\(0?[0-9]{2,4}\)|0{1,2}[0-9]{1,4}|[0-9]{3})[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,4}"
        r"(?![0-9]|[./-][0-9]|\x20[0-9]{4}(?![0-9]))"
    ),
}
# What certainly is none: an address without a domain, and dates, times and decimals.
NONE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?!\.[A-Za-z0-9-])",
    "phone": r"(?<![0-9.,:/+-])(?:(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}|[0-9]{1,3}[.,:][0-9]{1,2})(?![0-9.,:/-])",
}
GENERATORS = {1: BASE, 0: MORE, 2: NONE}
_CUES = r"(?i)(?:mail|tel|phone|call|fax|mobil|contact|card|visa|ip|host|server|addr|konto|tarjeta|carte|correo)"


def _needs(text: Column, kind: str, gen: int) -> Column:
    has, base = lambda s: F.instr(text, s) > 0, gen == 1
    if gen == 2:
        return has("@") if kind == "email" else text.rlike(r"[0-9][-./,:][0-9]")
    if kind == "email":
        return has("@") if base else text.rlike(r"(?i)[(\[{]at[)\]}]")
    if kind == "phone" and base:
        return has("+")
    if kind == "ip":
        return text.rlike(r"[0-9]\.[0-9]") if base else text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:")
    return text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}") if base else text.rlike(r"[0-9]{3}[)\x20./_-]{1,2}[0-9]{3}")


def _proposals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per text (rid, id) with its proposals: arrays of (i, match, gap before it, contexts) per generator."""
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # documents of every fifth hash are kept from the fit
    t = t.withColumn("rid", F.monotonically_increasing_id()).withColumn("apart", F.pmod(F.xxhash64(F.lit(7), "t"), F.lit(5)) == 0).withColumn("any", F.col("t").rlike(r"[0-9@]|(?i)[(\[{]at[)\]}]"))
    names = []
    for gen, patterns in GENERATORS.items():
        for kind, pattern in patterns.items():
            name = f"{kind}{gen}"
            names.append(name)
            here = F.col("any") & _needs(F.col("t"), kind, gen)
            t = t.withColumn(f"{name}_m", F.when(here, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))))
            # the pieces between matches give the positions
            t = t.withColumn(f"{name}_g", F.when(F.size(f"{name}_m") > 0, F.split("t", pattern, -1)))
    for name in names:
        one = F.expr(
            f"transform({name}_m, (m, i) -> struct(i as i, m as m, length({name}_g[i]) as gap,"
            f" right({name}_g[i], 16) as before, left({name}_g[i + 1], 4) as after))"
        )
        t = t.withColumn(name, F.when(F.size(f"{name}_m") > 0, one))
    return t.select("rid", "id", "apart", *names)


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits has the right check digit."""
    places = F.sequence(F.lit(1), F.length(digits))
    double = lambda i: F.substring(digits, -i, F.lit(1)).cast("int") * (2 - i % 2)
    total = F.aggregate(places, F.lit(0), lambda a, i: a + F.when(double(i) > 9, double(i) - 9).otherwise(double(i)))
    return total % 10 == 0


def _spans(proposals: DataFrame) -> DataFrame:
    """rid, apart, kind (its number), role (1 base, 0 proposed, -1 none), check, m, digits, start, end, before, after, and
    over: whether a base span overlaps it."""
    parts = []
    for gen, patterns in GENERATORS.items():
        for kind in patterns:
            name = f"{kind}{gen}"
            found = proposals.where(F.col(name).isNotNull()).select(
                "rid", "apart", F.lit(KINDS.index(kind)).alias("kind"), F.lit(gen).alias("gen"), F.explode(name).alias("c")
            )
            parts.append(found.select("rid", "apart", "kind", "gen", "c.*"))
    s = parts[0]
    for p in parts[1:]:
        s = s.unionAll(p)
    upto = Window.partitionBy("rid", "kind", "gen").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("size", F.length("m")).withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).withColumn("start", F.col("end") - F.col("size"))
    digits = F.regexp_replace("m", "[^0-9]", "")
    n = F.length(digits)
    parts_ok = F.forall(F.split("m", r"\."), lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & F.forall(
        F.split("m", r"\."), lambda p: F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255
    )
    valid = (
        F.when(F.col("kind") == 0, F.lit(True))
        .when(F.col("kind") == 1, parts_ok)
        .when(F.col("kind") == 2, n.between(13, 19) & luhn(F.when(n.between(13, 19), digits).otherwise("")))
        .otherwise(n.between(9, 15))
    )
    # the same question for every generator: is it whole by its kind's own rules?
    plain = F.regexp_replace("m", r"(?i)\x20?[(\[{]dot[)\]}]\x20?", ".")
    check = (
        F.when(F.col("kind") == 0, plain.rlike(r"\.[A-Za-z]{2,}$"))
        .when(F.col("kind") == 1, F.when(F.col("gen") == 1, parts_ok).otherwise(F.col("m").rlike("[A-Fa-f]")))
        .when(F.col("kind") == 2, n.between(13, 19) & luhn(F.when(n.between(13, 19), digits).otherwise("")))
        .otherwise((F.col("gen") != 2) & n.between(7, 15))
    )
    s = s.withColumn("role", F.when(F.col("gen") == 0, F.lit(0)).when((F.col("gen") == 1) & valid, F.lit(1)).otherwise(F.lit(-1)))
    s = s.withColumn("base", F.col("role") == 1).withColumn("digits", n).withColumn("check", F.coalesce(check, F.lit(False)))
    # what lies ahead is read in descending order: a frame that ends at the last row costs the square of the rows
    order = ["start", "end", "kind", "gen"]
    upto_here = lambda keys: Window.partitionBy("rid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    back, ahead = upto_here(order), upto_here([F.desc(c) for c in order])
    b_end, b_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    over = (F.coalesce(F.max(b_end).over(back), F.lit(-1)) > F.col("start")) | (F.coalesce(F.min(b_start).over(ahead), F.lit(1 << 60)) < F.col("end"))
    return s.withColumn("over", over)


def _features() -> list[Column]:
    alnum = "[A-Za-z0-9]"
    # of numbers, the separators between groups: not brackets and the +, which tell the base from the rest
    seps = F.regexp_replace("m", r"[A-Za-z0-9()+\[\]{}@]", "")
    return [
        *[F.col("kind") == k for k in range(4)],
        F.col("check"),
        F.col("before").rlike(_CUES),
        F.col("before").rlike(f"{alnum}$"),
        F.col("after").rlike(f"^{alnum}"),
        F.col("after").rlike(r"^[@:/=]"),
        F.length(F.translate(seps, " -.", "")) > 0,
        F.col("m").rlike(r"[0-9]{3,4}[\x20./-][0-9]{3,4}$"),
        F.col("m").rlike(r"(?:[0-9]{4}.){3}[0-9]{4}$|^[0-9]{13,19}$"),
    ]


@dataclass
class Trees:
    """Boosted trees of depth two on bits: (feature, (feature, leaf, leaf), (feature, leaf, leaf)), no before yes."""

    start: float
    trees: list[tuple]

    def score(self, code: int) -> float:
        bit = lambda f: code >> f & 1
        total = self.start
        for f, no, yes in self.trees:
            g, a, b = yes if bit(f) else no
            total += b if bit(g) else a
        return total

    def column(self, code: Column) -> Column:
        bit = lambda f: F.getbit(code, F.lit(f)) == 1
        total = F.lit(self.start)
        for f, no, yes in self.trees:
            side = [F.when(bit(g), F.lit(b)).otherwise(F.lit(a)) for g, a, b in (no, yes)]
            total = total + F.when(bit(f), side[1]).otherwise(side[0])
        return total


def fit_trees(patterns: list[tuple[int, int, int]], n_features: int, rounds: int = 12, rate: float = 0.5, ridge: float = 1.0) -> Trees:
    """Logistic boosting on (bit pattern, rows, positive rows); each split has the best second-order gain."""
    rows, good = sum(p[1] for p in patterns), sum(p[2] for p in patterns)
    start = math.log((good + 1) / (rows - good + 1))
    score = {c: start for c, _, _ in patterns}
    trees = []

    def best(part: list[tuple[int, float, float]]) -> tuple[float, int, float, float]:
        found = (-1.0, 0, 0.0, 0.0)
        for f in range(n_features):
            g, h = [0.0, 0.0], [0.0, 0.0]
            for code, dg, dh in part:
                g[code >> f & 1] += dg
                h[code >> f & 1] += dh
            gain = sum(x * x / (y + ridge) for x, y in zip(g, h, strict=True))
            if gain > found[0] + 1e-12:
                found = (gain, f, *(rate * x / (y + ridge) for x, y in zip(g, h, strict=True)))
        return found

    for _ in range(rounds):
        part = []
        for code, n, pos in patterns:
            p = 1 / (1 + math.exp(-score[code]))
            part.append((code, pos - n * p, n * p * (1 - p)))
        # the first split is the one whose two best second splits gain most
        options = []
        for f in range(n_features):
            sides = [best([x for x in part if x[0] >> f & 1 == side]) for side in (0, 1)]
            options.append((sides[0][0] + sides[1][0], -f, [s[1:] for s in sides]))
        _, f, sides = max(options, key=lambda o: (o[0], o[1]))
        tree = (-f, *sides)
        trees.append(tree)
        one = Trees(0.0, [tree])
        for code in score:
            score[code] += one.score(code)
    return Trees(start, trees)


def calibrated_bar(scored: list[tuple[float, int, int]], precision: float, support: int) -> float:
    """The lowest score from which on the share of positives, made monotone, reaches ``precision``; inf if none does.

    scored: (score, rows, positive rows). A level counts with at least ``support`` rows.
    """
    blocks: list[list[float]] = []  # pool adjacent violators
    for s, n, pos in sorted(scored):
        blocks.append([s, n, pos])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            _, n1, p1 = blocks.pop()
            blocks[-1][1] += n1
            blocks[-1][2] += p1
    good = [s for s, n, pos in blocks if pos / n >= precision and n >= support]
    return min(good, default=math.inf)


def balanced(patterns: list[tuple[int, int, int]]) -> list[tuple[int, float, float]]:
    """(bits, rows, positive rows) with the negatives of each kind weighing as much as its positives in all."""
    out = []
    for k in range(4):
        own = [p for p in patterns if p[0] >> k & 1]
        good, bad = sum(p[2] for p in own), sum(p[1] - p[2] for p in own)
        weight = good / bad if good and bad else 1.0
        out += [(c, pos + (n - pos) * weight, float(pos)) for c, n, pos in own]
    return sorted(out)


def fit_thresholds(counts: list[tuple[int, bool, int, int]], n_features: int, precision: float) -> tuple[Trees, list[float]]:
    """Trees, and the bar of each kind, from (bits, kept apart, rows, positive rows).

    The bar is the lowest score that reaches the precision on the rows kept apart; where a kind has no such rows
    of both classes, on those of all kinds; without any, on the rows of the fit.
    """
    # one row that fails its check for each kind, so that it counts against a span also where no text holds one
    prior = [(1 << k, 1, 0) for k in range(4)]
    fit, rest = ([(c, n, pos) for c, apart, n, pos in counts if apart == side] for side in (False, True))
    trees = fit_trees(balanced(fit + prior), n_features)

    def bar(k: int) -> float:
        for rows, kinds in ((rest, (k,)), (rest, range(4)), (fit + prior, range(4))):
            own = balanced([p for p in rows if any(p[0] >> j & 1 for j in kinds)])
            if any(p[2] for p in own) and any(p[1] > p[2] for p in own):
                return calibrated_bar([(trees.score(c), n, pos) for c, n, pos in own], precision, 0)
        return math.inf

    return trees, [bar(k) for k in range(4)]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.97) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows has rid and id of every input row; spans has rid, kind, start, end (code points, end exclusive), base, score.

    A null or empty text has no spans. Rows with null or repeated ids are kept apart by rid. Added spans never
    overlap a base span; those of different kinds may overlap each other. Whole texts are read; other columns
    are not. Without base spans in the table nothing can be learned and nothing is added. An empty table gives no rows.
    """
    found = materialize(_proposals(docs, id_col, text_col), "pii-proposals")
    features = _features()
    code = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(features[1:], 1)), F.when(features[0], F.lit(1)).otherwise(F.lit(0)))
    spans = materialize(_spans(found).select("rid", "apart", "kind", "start", "end", "role", "base", "over", code.alias("code")), "pii-spans")
    # at most 2 ** features patterns, twice, whatever the corpus
    sure = spans.where((F.col("role") == 1) | ((F.col("role") == -1) & ~F.col("over")))
    counts = sure.groupBy("code", "apart").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base").cast("int")).alias("pos")).collect()
    trees, bars = fit_thresholds([(r["code"], r["apart"], r["n"], r["pos"]) for r in counts], len(features), precision)
    bar = F.element_at(F.array(*[F.lit(float(b)) for b in bars]), F.col("kind") + 1)
    scored = spans.where("role >= 0").withColumn("score", trees.column(F.col("code")))
    chosen = F.col("base") | (~F.col("over") & (F.col("score") >= bar))
    return found.select("rid", "id"), scored.where(chosen).drop("over", "code", "role", "apart")


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every span replaced by its kind in brackets; spans has the id beside kind, start and end.

    Of overlapping spans, the one that starts first (then the longer) is named and the others' rest goes with it.
    A null text stays null, a text without spans as it is; only the id and text of ``docs`` are read.
    """
    s = spans.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("e"), "kind"))).alias("s"))
    step = F.expr(
        "aggregate(s, struct(0L as at, '' as out), (a, x) -> if(x.start >= a.at,"
        " struct(-x.e as at, concat(a.out, substring(t, cast(a.at as int) + 1, cast(x.start - a.at as int)), '[',"
        " element_at(array('email','ip','card','phone'), x.kind + 1), ']') as out),"
        " struct(greatest(a.at, -x.e) as at, a.out as out)),"
        " a -> concat(a.out, substring(t, cast(a.at as int) + 1)))"
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(s, "id", "left")
    return rows.select(F.col("id").alias(id_col), F.when(F.col("s").isNull(), F.col("t")).otherwise(step).alias(text_col))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """All documents: counts and a digest of base spans, and all spans."""
    rows, spans = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    spans = spans.withColumn("s", F.struct("kind", "start", "end", F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string")).alias("name")))
    listed = lambda s: F.array_join(F.transform(F.array_sort(s), lambda x: x["name"]), ",")
    by_row = spans.groupBy("rid").agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        listed(F.collect_list(F.when(F.col("base"), F.col("s")))).alias("base"), listed(F.collect_list("s")).alias("spans"),
    )
    return rows.join(by_row, "rid", "left").select(
        F.col("id").alias("doc_id"),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
