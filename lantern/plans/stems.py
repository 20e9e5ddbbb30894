"""The stemmer as SQL over a table of distinct words, for the SQL counterparts of stemmed scores."""

from __future__ import annotations

from lantern.functions.overlap import FOURTH, IRREGULAR, SECOND, THIRD


def shape(x: str) -> str:
    """V for a vowel, C for a consonant; y is a vowel after a consonant (runs of up to six of them)."""
    made = f"regexp_replace(regexp_replace({x}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    made = f"regexp_replace({made}, '^y', 'C')"
    for _ in range(3):
        made = f"replace(replace({made}, 'Cy', 'CV'), 'Vy', 'VC')"
    return made


def measure(x: str) -> str:
    return f"((length({shape(x)}) - length(replace({shape(x)}, 'VC', ''))) // 2)"


def short_ending(x: str) -> str:
    return (
        f"CASE WHEN length({x}) = 2 THEN {shape(x)} = 'VC' ELSE {shape(x)} LIKE '%CVC' AND right({x}, 1) NOT IN ('w', 'x', 'y') END"
    )


def cut(x: str, n: int) -> str:
    return f"left({x}, length({x}) - {n})"


def without_plural(x: str) -> str:
    return (
        f"CASE WHEN {x} LIKE '%ies' AND length({x}) = 4 THEN {cut(x, 1)} WHEN {x} LIKE '%sses' OR {x} LIKE '%ies' THEN {cut(x, 2)} "
        f"WHEN {x} LIKE '%s' AND {x} NOT LIKE '%ss' THEN {cut(x, 1)} ELSE {x} END"
    )


def suffixed(source: str, table: list[tuple[str, str]], fits: str, again: str = "true") -> str:
    """``source`` (w, x, first) with the first listed suffix of x exchanged where ``again`` and ``fits`` hold."""
    length = " ".join(f"WHEN x LIKE '%{s}' THEN {len(s)}" for s, _ in table)
    other = " ".join(f"WHEN x LIKE '%{s}' THEN '{r}'" for s, r in table)
    return f"""(SELECT w, CASE WHEN k IS NOT NULL AND {fits} THEN root || r ELSE x END AS x, k IS NOT NULL AND suffix = 'alli' AND {fits} AS first
        FROM (SELECT *, left(x, length(x) - k) AS root, right(x, k) AS suffix FROM (
            SELECT *, CASE WHEN NOT {again} THEN NULL {length} END AS k, CASE {other} END AS r FROM {source})))"""


def sql_stems(words: str) -> str:
    """``w`` and ``stem`` of the words (``w``) of a table."""
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    step = f"(SELECT w, {without_plural('w')} AS x FROM {words} WHERE length(w) > 3)"
    past = f"""CASE WHEN x LIKE '%ied' THEN CASE WHEN length(x) = 4 THEN {cut('x', 1)} ELSE {cut('x', 2)} END
        WHEN x LIKE '%eed' THEN CASE WHEN {measure(cut('x', 3))} > 0 THEN {cut('x', 1)} ELSE x END
        WHEN root IS NULL OR {shape('root')} NOT LIKE '%V%' THEN x
        WHEN right(root, 2) IN ('at', 'bl', 'iz') THEN root || 'e'
        WHEN length(root) > 1 AND right(root, 1) = left(right(root, 2), 1) AND {shape('root')} LIKE '%C'
            THEN CASE WHEN right(root, 1) IN ('l', 's', 'z') THEN root ELSE {cut('root', 1)} END
        WHEN {measure('root')} = 1 AND {short_ending('root')} THEN root || 'e' ELSE root END"""
    step = f"""(SELECT w, {past} AS x FROM (SELECT *, CASE WHEN x LIKE '%ed' THEN {cut('x', 2)}
        WHEN x LIKE '%ing' THEN {cut('x', 3)} END AS root FROM {step}))"""
    step = f"""(SELECT w, CASE WHEN x LIKE '%y' AND length(x) > 2 AND {shape(cut('x', 1))} LIKE '%C'
        THEN {cut('x', 1)} || 'i' ELSE x END AS x, true AS first FROM {step})"""
    second = measure("CASE WHEN suffix = 'logi' THEN root || 'l' ELSE root END") + " > 0"
    step = suffixed(suffixed(step, SECOND, second), SECOND, second, again="first")
    step = suffixed(step, THIRD, f"{measure('root')} > 0")
    ion = "(suffix <> 'ion' OR right(root, 1) IN ('s', 't'))"
    step = suffixed(step, [(s, "") for s in FOURTH], f"{measure('root')} > 1 AND {ion}")
    root = cut("x", 1)
    step = f"""(SELECT w, CASE WHEN x LIKE '%e' AND ({measure(root)} > 1 OR ({measure(root)} = 1 AND NOT ({short_ending(root)})))
        THEN {root} ELSE x END AS x FROM {step})"""
    return f"""SELECT w, CASE w {irregular} ELSE CASE WHEN x LIKE '%ll' AND {measure(root)} > 1 THEN {root} ELSE x END END AS stem
        FROM {step}"""
