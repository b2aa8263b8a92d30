"""Parsing, JSON, cost and flag expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_fold(lines: Column, labels: Sequence[tuple[str, str]]) -> Column:
    """Label lines to fields: (field, pattern with one group) in order; a line without a label continues the last field."""
    names = [n for n, _ in labels]
    empty = F.struct(*[F.lit("").alias(n) for n in names], F.lit("").alias("last"))

    def step(a: Column, line: Column) -> Column:
        line = F.btrim(line)
        out = F.struct(*[F.when((a["last"] == n) & (line != ""), F.btrim(F.concat(a[n], F.lit(" "), line))).otherwise(a[n]).alias(n) for n in names], a["last"].alias("last"))
        for name, pattern in reversed(labels):
            hit = F.struct(*[(F.btrim(F.regexp_extract(line, pattern, 1)) if n == name else a[n]).alias(n) for n in names], F.lit(name).alias("last"))
            out = F.when(line.rlike(pattern), hit).otherwise(out)
        return out

    return F.aggregate(lines, empty, step, lambda a: F.struct(*[a[n].alias(n) for n in names]))


def capture(c: Column, *patterns: str) -> Column:
    """The first pattern's group that isn't empty."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns])


def first_json(c: Column, schema: str, *paths: str) -> Column:
    """The first JSON object inside a text, or inside the first of the texts at `paths` of a JSON response that holds one."""
    texts = [F.get_json_object(c, p) for p in paths] or [c]
    # a path with a wildcard gives a list of quoted texts: unquote what it holds
    texts = [F.when(F.substring(t, 1, 2) == '["', F.array_join(F.from_json(t, "array<string>"), "\n")).otherwise(t) for t in texts]
    return F.from_json(capture_any(texts, r"(?s)(\{.*\})"), schema)


def capture_any(texts: Sequence[Column], pattern: str) -> Column:
    """The first group of the first text in which the pattern's isn't empty."""
    return F.coalesce(*[F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")) for t in texts])


def json_number(c: Column, *keys: str, default: int | None = None) -> Column:
    """The first key that is present and numeric, as a whole number: numbers lose what is behind the point, texts count if
    they are digits only, true and false do not; 0 counts. `default` stands for none."""
    json = F.try_parse_json(c)

    def one(key: str) -> Column:
        part = F.try_variant_get(json, f"$.{key}", "variant")
        kind, text = F.schema_of_variant(part), F.try_variant_get(json, f"$.{key}", "string")
        digits = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
        return F.when(kind == "STRING", digits).when(kind == "BIGINT", F.try_variant_get(json, f"$.{key}", "bigint")).when(kind.rlike("^(DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(json, f"$.{key}", "double").cast("bigint"))

    found = [one(k) for k in keys]
    return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)


def tiered_cost(given: Column, cached: Column, made: Column, total: Column, thoughts: Column | None = None, rates: tuple[float, float, float] = (0.50, 3.00, 0.05)) -> Column:
    """Cost of given (of which cached) and made units, thoughts among them, per million; with a total alone, its upper bound."""
    zero = F.lit(0)
    given, made, total = F.coalesce(given, zero), F.coalesce(made, zero) + (zero if thoughts is None else F.coalesce(thoughts, zero)), F.coalesce(total, zero)
    hit = F.least(F.coalesce(cached, zero), given)
    split = (given - hit) * rates[0] + hit * rates[2] + made * rates[1]
    return F.when((given == 0) & (made == 0), total * max(rates[:2])).otherwise(split) / 1e6


def identity_check(parts: Sequence[Column], total: Column) -> tuple[Column, Column]:
    """A missing last part imputed as the residual, and whether the parts add up: Y, N or ?."""
    *known, last = parts
    rest = total
    for p in known:
        rest = rest - p
    imputed = F.coalesce(last, rest)
    whole = imputed
    for p in known:
        whole = whole + p
    return imputed, F.when(whole.isNull() | total.isNull(), "?").when(whole == total, "Y").otherwise("N")


def flags(*pairs: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def arbitrate(a: Column, b: Column, others: Sequence[Column], conf_a: Column, conf_b: Column) -> tuple[Column, Column]:
    """Of two readings of a name the one whose tokens the other field, in any of its readings, corroborates, ties by
    confidence; and whether they differed."""
    pool = F.flatten(F.array(*[F.split(F.upper(F.coalesce(o, F.lit(""))), r"\s+") for o in others]))
    score = lambda x: F.size(F.filter(F.split(F.upper(x), r"\s+"), lambda t: F.array_contains(pool, t)))
    take_b = (score(b) > score(a)) | ((score(b) == score(a)) & (conf_b > conf_a))
    return F.when((a != b) & take_b, b).otherwise(a), a != b


def arbitrate_simple(a: Column, b: Column, conf_a: Column, conf_b: Column) -> tuple[Column, Column]:
    """Of two readings of a plain field the surer one where both are given and differ; and whether that is so."""
    differ = F.coalesce((a.cast("string") != "") & (b.cast("string") != "") & (a != b), F.lit(False))
    return F.when(differ & (conf_b > conf_a), b).otherwise(a), differ


def box_within(inner: Column, outer: Column) -> Column:
    """Whether box (x, y, w, h) lies inside another, or on its edge."""
    return (inner["x"] >= outer["x"]) & (inner["y"] >= outer["y"]) & (inner["x"] + inner["w"] <= outer["x"] + outer["w"]) & (inner["y"] + inner["h"] <= outer["y"] + outer["h"])


def box_inside(inner: Column, outer: Column) -> Column:
    """Whether a box lies inside another without touching its edge."""
    return (inner["x"] > outer["x"]) & (inner["y"] > outer["y"]) & (inner["x"] + inner["w"] < outer["x"] + outer["w"]) & (inner["y"] + inner["h"] < outer["y"] + outer["h"])


def box_sized(box: Column, of: Column, width: tuple[float, float], height: tuple[float, float]) -> Column:
    """Whether a box has more than the first and less than the second of these shares of another's width and height."""
    return (box["w"] > width[0] * of["w"]) & (box["w"] < width[1] * of["w"]) & (box["h"] > height[0] * of["h"]) & (box["h"] < height[1] * of["h"])


def card_boxes(boxes: Column, page: Column, width: tuple[float, float] = (0.20, 0.40), height: tuple[float, float] = (0.04, 0.16), row: float = 0.02) -> Column:
    """The boxes of a page that have a card's size, in reading order: by `row` shares of the page's height, then x."""
    cards = F.filter(boxes, lambda b: box_sized(b, page, width, height))
    keyed = F.transform(cards, lambda b: F.struct(F.rint(b["y"] / (row * page["h"])).alias("row"), b["x"].alias("at"), b.alias("box")))
    return F.transform(F.array_sort(keyed), lambda k: k["box"])


def card_regions(card: Column, boxes: Column) -> Column:
    """A card's serial box and the x of its photo: the widest and the tallest (first of equals) of the boxes inside that
    have their sizes, with proportional places where there is none."""
    inside = F.filter(boxes, lambda b: box_inside(b, card))
    best = lambda which, side: F.array_max(F.transform(inside, lambda b, i: F.when(which(b), F.struct(b[side].alias("size"), (-i).alias("at"), b.alias("box")))))["box"]
    serial = best(lambda b: box_sized(b, card, (0.15, 0.5), (-1.0, 0.3)) & (b["y"] - card["y"] < 0.3 * card["h"]), "w")
    photo = best(lambda b: box_sized(b, card, (0.10, 0.35), (0.45, 9.0)), "h")
    place = F.struct(card["x"].alias("x"), card["y"].alias("y"), F.floor(0.35 * card["w"]).cast("int").alias("w"), F.floor(0.18 * card["h"]).cast("int").alias("h"))
    return F.struct(F.coalesce(serial, place).alias("serial"), F.coalesce(photo["x"], card["x"] + F.floor(0.74 * card["w"]).cast("int")).alias("photo_x"))


def unpack_box(c: Column) -> Column:
    p = F.split(c, ",")
    return F.struct(*[F.get(p, F.lit(i)).try_cast("int").alias(n) for i, n in enumerate("xywh")])
