"""Teaching depth of a topic: leading verb, then taxonomy level, then kind of class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed


def literal_map(pairs: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def depth_rank(depth: Column, missing: int | None = None) -> Column:
    rank = F.element_at(literal_map({d: i for i, d in enumerate(fixed.DEPTHS)}), depth)
    return F.coalesce(rank, F.lit(missing)) if missing is not None else rank


def depth_of_rank(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in fixed.DEPTHS]), rank + 1)


_FIRST_WORDS = r"^[^a-z]*([a-z]+)(?:[^a-z]+([a-z]+))?(?:[^a-z]+([a-z]+))?"


def leading_verb(text: Column, lexicon: dict[str, list[str]] = fixed.DEPTH_VERBS) -> Column:
    """First of the first three words that, less up to three end letters, is a known verb.

    Only the head of the text is scanned, and verbs are looked up by hash.
    """
    low = F.lower(text)
    words = F.array(*[F.regexp_extract(low, _FIRST_WORDS, i) for i in (1, 2, 3)])
    stems = F.flatten(F.transform(words, lambda word: F.array(*[
        F.substring(word, F.lit(1), F.length(word) - cut) for cut in range(4)
    ])))
    known = [verb for verbs in lexicon.values() for verb in verbs]
    return F.get(F.filter(stems, lambda stem: stem.isin(known)), F.lit(0))


def level_depth(level: Column) -> Column:
    """Depth of the highest taxonomy level (``BT1`` to ``BT6``) a text names."""
    levels = F.regexp_extract_all(F.upper(level), F.lit(r"BT\s*([1-6])"))
    top = F.array_max(F.transform(levels, lambda digit: digit.cast("int")))
    return (F.when(top <= 2, "know").when(top == 3, "apply").when(top > 3, "build"))


def depth_of_verb(verb: Column, level: Column, kind: Column,
                  lexicon: dict[str, list[str]] = fixed.DEPTH_VERBS) -> Column:
    """``struct(verb, depth)``; without a known verb the usual verb of the depth stands in."""
    fallback = F.coalesce(level_depth(level), F.when(kind == "practical", "apply").otherwise("know"))
    own = F.coalesce(*[F.when(verb.isin(verbs), F.lit(depth)) for depth, verbs in lexicon.items()])
    return F.struct(
        F.coalesce(verb, F.element_at(literal_map(fixed.USUAL_VERB), fallback)).alias("verb"),
        F.coalesce(own, fallback).alias("depth"),
    )


def inferred_depth(fragment: Column, level: Column, kind: Column,
                   lexicon: dict[str, list[str]] = fixed.DEPTH_VERBS) -> Column:
    return depth_of_verb(leading_verb(fragment, lexicon), level, kind, lexicon)
