"""Name functions: normalisation, similarity, what a name states, vetoes and corroboration.

All take and give Columns. Only folding what is not plain ASCII and counting common subsequences leave the JVM, as
Arrow UDFs.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from . import similarity
from . import vocabulary as V


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def words(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _among(token: Column, values) -> Column:
    return token.isin(*values)


# --- normalisation

_SPACED = re.compile(V.SPACED_LETTERS)


def fold(text: str | None) -> str:
    """Lower case, entities and accents resolved, "&" as "and", anything but letters and digits as single spaces."""
    text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text or "")
    text = html.unescape(text).lower().replace("&", " and ")
    kept = (c if c.isalnum() else " " for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join("".join(kept).split())


@F.pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(fold, na_action="ignore")


def norm(text: Column | str) -> Column:
    """The normalised name; empty for null. Plain ASCII names without entities or spaced letters never leave the JVM."""
    text = F.col(text) if isinstance(text, str) else text
    odd = text.rlike(r"[^\x00-\x7F]|&[#A-Za-z]|" + V.SPACED_LETTERS)
    plain = F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), r"[^a-z0-9]+", " "))
    return F.when(text.isNull(), F.lit("")).when(odd, _folded(F.when(odd, text))).otherwise(plain)


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def resolve_access(name: Column) -> Column:
    """"access" and its kin become "accessible" where they mean step-free access, and vanish where they mean a perk."""

    def sense(all_tokens: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(all_tokens, i - 1)).otherwise(F.lit(""))
            perk = (t == "access") | _among(before, V.PERK_WORDS)
            return F.when(~_among(t, V.ACCESS_WORDS), t).when(_among(before, V.DISABILITY), F.lit("accessible")).when(perk, F.lit("")).otherwise(F.lit("accessible"))

        return F.filter(F.transform(all_tokens, one), lambda t: t != "")

    return F.array_join(let(tokens(F.regexp_replace(name, V.DISABILITY_PHRASE, "disabled")), sense), " ")


def norm_room(raw: Column) -> Column:
    """A room's name without what belongs to the offer: echoes, rates, perks, promotions, sizes, years."""
    text = norm(F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r"\[.*?\]", " "), r"\b\d+\s*%", " "))
    for pattern, joined in V.SPLIT_WORDS:
        text = F.regexp_replace(text, pattern, joined)
    short = F.create_map(*[F.lit(x) for pair in V.ABBREVIATIONS.items() for x in pair])
    whole = F.transform(tokens(resolve_access(text)), lambda t: F.coalesce(F.try_element_at(short, t), t))

    def before_promotion(ts: Column) -> Column:
        starts = F.transform(ts, lambda t, i: F.when((i > 0) & _among(t, V.PROMO_STARTS), i))
        return F.slice(ts, F.lit(1), F.coalesce(F.array_min(starts), F.size(ts)))

    def without_codes(ts: Column) -> Column:
        last = F.array_max(F.transform(ts, lambda t, i: F.when(~_among(t, V.BOARD_CODES), i + 1)))
        return F.slice(ts, F.lit(1), F.coalesce(last, F.lit(0)))

    noise = [*V.RATE_WORDS, *V.PROMO_WORDS, *V.PERK_WORDS]
    kept = F.filter(let(let(whole, before_promotion), without_codes), lambda t: ~_among(t, noise) & ~t.rlike(V.DIMENSION) & ~t.rlike(V.YEAR))
    return F.array_join(F.array_distinct(kept), " ")


# --- similarity


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & places.get(c, 0)
        row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def sort_ratio(a: str, b: str) -> float:
    """Similarity of the names with their words sorted; 0 if either is empty."""
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) if a and b else 0.0


def set_ratio(a: str, b: str) -> float:
    """Similarity that forgives one name's words being a superset of the other's; 0 if either is empty."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (only_x and only_y):
        return 100.0
    gap = 1 if both else 0
    size_x, size_y = len(both) + gap + len(only_x), len(both) + gap + len(only_y)
    distance = len(only_x) + len(only_y) - 2 * common_subsequence(only_x, only_y)
    best = 100.0 - 100.0 * distance / (size_x + size_y)
    if both:
        for size in (size_x, size_y):
            best = max(best, 100.0 - 100.0 * (size - len(both)) / (size + len(both)))
    return best


class _One:
    """The measures of one pair, for pairs that do not fit arrays."""

    common_subsequence, set_ratio = staticmethod(common_subsequence), staticmethod(set_ratio)


def _pairwise(measure: Callable[[similarity.Pairs], np.ndarray]):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return similarity.pairwise(a, b, measure, _One)

    return run


plain_ratio = F.pandas_udf(_pairwise(lambda p: p.plain()), DoubleType())
strict_score = F.pandas_udf(_pairwise(lambda p: p.strict()), DoubleType())
set_score = F.pandas_udf(_pairwise(lambda p: p.sets()), DoubleType())
score = F.pandas_udf(_pairwise(lambda p: p.score()), DoubleType())
#: Of two normalised room names, with and without the filler word.
room_score = F.pandas_udf(_pairwise(lambda p: p.rooms(frozenset(V.FILLER))), DoubleType())


def word_parts(name: Column) -> Column:
    """Of a normalised name what ``may_score`` compares: its words, these sorted and joined, and whether one comes twice."""
    ws = F.split(name, " ")
    return F.struct(ws.alias("words"), F.array_join(F.array_sort(ws), " ").alias("sorted"), (F.size(F.array_distinct(ws)) < F.size(ws)).alias("twice"))


def may_be_strict(a: Column, b: Column, least: Column) -> Column:
    """False only where ``strict_score`` of two names (``word_parts``) is below ``least``: edits are never more than the letters that are not common."""
    x, y = a["sorted"], b["sorted"]
    most = F.floor((F.length(x) + F.length(y)) * (100 - least) / 100 + 1e-6).cast("int")
    return (F.abs(F.length(x) - F.length(y)) <= most) & (F.call_function("levenshtein", x, y, most) >= 0)


def may_score(a: Column, b: Column, least: float) -> Column:
    """False only where ``score`` of two names (``word_parts``) is below ``least``: without a word in common, or one that comes twice, sets score as words sorted do."""
    return F.arrays_overlap(a["words"], b["words"]) | a["twice"] | b["twice"] | may_be_strict(a, b, F.lit(least))


# --- listings


def unit_marks(name: Column) -> Column:
    """Digit runs and compass words of a normalised name, sorted."""
    return F.array_sort(F.array_union(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), F.array_intersect(tokens(name), words(V.COMPASS))))


def same_listing(a: Column, b: Column, floor: float = V.SAME_LISTING, drop: Column | None = None) -> Column:
    """Whether two normalised names are one and the same listing: alike as a whole, with the same unit marks; ``drop`` is a normalised phrase that does not count."""
    if drop is not None:
        phrase = F.coalesce(F.nullif(F.trim(drop), F.lit("")), F.lit("\n"))  # a normalised name holds no line break
        strip = lambda n: F.array_join(tokens(F.regexp_replace(n, F.concat(F.lit(r"(?<!\S)"), phrase, F.lit(r"(?!\S)")), F.lit(" "))), " ")
        a, b = strip(a), strip(b)
    return (strict_score(a, b) >= floor) & (unit_marks(a) == unit_marks(b))


# --- what a room's name states


def view_of(name: Column) -> Column:
    """Up to three words before the first "view", back to a stop word or a number; null if there is none."""

    def before(ts: Column) -> Column:
        at = F.array_position(ts, "view").cast("int")
        back = F.reverse(F.slice(ts, F.greatest(at - 3, F.lit(1)), F.greatest(F.least(at - 1, F.lit(3)), F.lit(0))))
        stop = F.array_min(F.transform(back, lambda t, i: F.when(_among(t, V.VIEW_STOPS) | t.rlike(r"^\d+$"), i)))
        kept = F.reverse(F.slice(back, F.lit(1), F.coalesce(stop, F.size(back))))
        return F.when((at > 1) & (F.size(kept) > 0), F.array_join(kept, " "))

    return let(tokens(name), before)


def bedrooms(name: Column) -> Column:
    """Stated number of bedrooms; 0 for a studio, null if none is stated."""
    number = F.regexp_extract(name, r"(\d+|" + "|".join(V.NUMBERS) + ")" + V.BEDROOM_WORDS, 1)
    spelled = F.create_map(*[x for w, n in V.NUMBERS.items() for x in (F.lit(w), F.lit(n))])
    return F.when(F.array_contains(tokens(name), "studio"), F.lit(0)).when(number != "", F.coalesce(F.try_element_at(spelled, number), number.try_cast("int")))


def features(name: Column) -> Column:
    """Struct of classes, view, beds, bedrooms, tiers, accessible of a normalised room name."""

    def of(ts: Column) -> tuple[Column, ...]:
        classes = F.array_compact(F.array(*[F.when(F.size(F.array_intersect(words(c.split()), ts)) == len(c.split()), F.lit(c)) for c in sorted(V.CLASSES)]))
        beds = F.array_compact(F.array(*[F.when(F.array_contains(ts, b) | F.array_contains(ts, b + "s"), F.lit(b)) for b in sorted(V.BEDS)]))
        same = F.create_map(*[F.lit(x) for pair in V.TIER_SYNONYMS.items() for x in pair])
        tiers = F.array_sort(F.array_distinct(F.transform(F.array_intersect(words(V.TIERS), ts), lambda t: F.coalesce(F.try_element_at(same, t), t))))
        return classes, beds, tiers

    ts = tokens(name)
    classes, beds, tiers = of(ts)
    return F.struct(
        F.when(F.size(classes) > 0, classes).otherwise(words(["room"])).alias("classes"),
        view_of(name).alias("view"),
        beds.alias("beds"),
        bedrooms(name).alias("bedrooms"),
        tiers.alias("tiers"),
        F.arrays_overlap(ts, words(V.ACCESSIBILITY)).alias("accessible"),
    )


# --- pairs of rooms; a and b are feature structs, na and nb normalised names


def _apart(x: Column, y: Column) -> Column:
    return (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)


def veto(a: Column, b: Column) -> Column:
    """The first stated contradiction, or null."""
    slash = lambda x: F.array_join(x, "/")
    views = a["view"].isNotNull() & b["view"].isNotNull()
    return (
        F.when(_apart(a["classes"], b["classes"]), F.concat(F.lit("class "), slash(a["classes"]), F.lit(" vs "), slash(b["classes"]), F.lit(" disjoint")))
        .when(_apart(a["tiers"], b["tiers"]), F.concat(F.lit("tiers "), slash(a["tiers"]), F.lit(" vs "), slash(b["tiers"]), F.lit(" disjoint")))
        .when(a["bedrooms"] != b["bedrooms"], F.concat(F.lit("bedrooms "), a["bedrooms"], F.lit(" != "), b["bedrooms"]))
        .when(views & ~F.arrays_overlap(tokens(F.coalesce(a["view"], F.lit(""))), tokens(F.coalesce(b["view"], F.lit("")))), F.concat(F.lit("view '"), a["view"], F.lit("' vs '"), b["view"], F.lit("' disjoint")))
        .when(_apart(a["beds"], b["beds"]), F.concat(F.lit("beds "), slash(a["beds"]), F.lit(" vs "), slash(b["beds"]), F.lit(" disjoint")))
    )


def is_soft(reason: Column) -> Column:
    """Whether a veto concerns a label (tier or view) and not the room itself."""
    return F.coalesce(F.substring_index(reason, " ", 1).isin("tiers", "view"), F.lit(False))


def beds_agree(a: Column, b: Column) -> Column:
    """1 for equal beds, -1 for others, 0 where a name states none."""
    both = (F.size(a["beds"]) > 0) & (F.size(b["beds"]) > 0)
    return F.when(~both, 0).when(a["beds"] == b["beds"], 1).otherwise(-1)


def shifted(raw: Column, agree: Column, differ: Column) -> Column:
    """The pair's score: +4 for equal beds (100 at most), -8 for others; capped where accessibility differs."""
    s = F.when(agree == 0, raw).when(agree == 1, F.least(F.lit(100.0), raw + 4)).otherwise(raw - 8)
    return F.bround(F.when(differ, F.least(s, F.lit(V.ACCESS_CAP))).otherwise(s), 1)


def adjusted(raw: Column, a: Column, b: Column) -> Column:
    return shifted(raw, beds_agree(a, b), a["accessible"] != b["accessible"])


def shared_words(na: Column, nb: Column) -> Column:
    return F.array_sort(F.array_except(F.array_intersect(tokens(na), tokens(nb)), words(V.GENERIC)))


def corroborations(a: Column, b: Column, na: Column, nb: Column) -> Column:
    """What the two names positively agree on; empty where accessibility differs."""
    shared = shared_words(na, nb)
    found = F.array_compact(
        F.array(
            F.when(F.arrays_overlap(a["tiers"], b["tiers"]), F.lit("tier")),
            F.when(a["bedrooms"] == b["bedrooms"], F.lit("bedrooms")),
            F.when(F.arrays_overlap(a["beds"], b["beds"]), F.lit("beds")),
            F.when(F.size(shared) > 0, F.concat(F.lit("word:"), F.substring(F.array_join(shared, "/"), 1, 32))),
        )
    )
    return F.when(a["accessible"] == b["accessible"], found).otherwise(F.array().cast("array<string>"))


def backed(a: Column, b: Column) -> Column:
    """Whether features alone corroborate a pair, as in ``corroborations``."""
    return F.coalesce((a["accessible"] == b["accessible"]) & (F.arrays_overlap(a["tiers"], b["tiers"]) | F.coalesce(a["bedrooms"] == b["bedrooms"], F.lit(False)) | F.arrays_overlap(a["beds"], b["beds"])), F.lit(False))


def category(name: Column) -> Column:
    """The taxonomy's category of a normalised room name; the order of the rules decides."""
    out, n_bedrooms = F.when(name == "", F.lit(V.FALLBACK_CATEGORY)), bedrooms(name)
    for label, pattern in V.CATEGORY_RULES:
        if label == "Apartment":
            for n, sized in enumerate(V.BEDROOM_CATEGORIES[:3], 1):
                out = out.when(n_bedrooms == n, F.lit(sized))
            out = out.when(n_bedrooms > 3, F.lit(V.BEDROOM_CATEGORIES[3]))
        out = out.when(name.rlike(pattern), F.lit(label))
    return out.otherwise(F.lit(V.FALLBACK_CATEGORY))


def all_categories() -> list[str]:
    labels = [label for label, _ in V.CATEGORY_RULES]
    at = labels.index("Apartment")
    return [*labels[:at], *V.BEDROOM_CATEGORIES, *labels[at:], V.FALLBACK_CATEGORY]
