"""Oracle of the stemming variant: the stemmer's rules as SQL CASE steps over
distinct tokens.  Written from the rules, not from the Python helper."""

from __future__ import annotations

from lexis.functions.porter import IRREGULAR

STEP2 = [("ational", "ate"), ("ization", "ize"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("tional", "tion"),
         ("biliti", "ble"), ("entli", "ent"), ("ousli", "ous"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("iviti", "ive"),
         ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("alli", "al"), ("ator", "ate"), ("bli", "ble"),
         ("eli", "e")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", "")]
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ion", "ism", "ate", "iti", "ous", "ive", "ize",
         "al", "er", "ic", "ou"]


def shape(e: str) -> str:
    """Consonants and vowels of a word as a string of C and V; a y is a vowel
    after a consonant, decided from left to right."""
    e = f"regexp_replace(regexp_replace({e}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    e = f"regexp_replace({e}, '^y', 'C')"
    for _ in range(3):
        e = f"replace(replace({e}, 'Vy', 'VC'), 'Cy', 'CV')"
    return e


def measure(e: str) -> str:
    return f"len(regexp_extract_all({shape(e)}, 'V+C+'))"


def cut(suffix: str, w: str = "w") -> str:
    return f"left({w}, length({w}) - {len(suffix)})"


def cvc(w: str) -> str:
    return (f"((length({w}) >= 3 AND right({shape(w)}, 3) = 'CVC' AND right({w}, 1) NOT IN ('w', 'x', 'y')) "
            f"OR (length({w}) = 2 AND {shape(w)} = 'VC'))")


def _rules(rules, least: int, extra: str = "") -> str:
    whens = " ".join(f"WHEN ends_with(w, '{s}') THEN CASE WHEN {measure(cut(s))} > {least} THEN {cut(s)} || '{r}' ELSE w END"
                     for s, r in rules)
    return f"CASE {extra} {whens} ELSE w END"


def stem_ctes(src: str = "corpus", cleaned: str = "cleaned") -> str:
    """CTEs over ``{src}(text_id, {cleaned})`` ending in ``stems(tok, stem)``."""
    odd = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    logi = f"WHEN ends_with(w, 'logi') THEN CASE WHEN {measure(cut('ogi'))} > 0 THEN {cut('i')} ELSE w END"
    ion = (f"WHEN ends_with(w, 'ion') AND NOT ends_with(w, 'ement') THEN CASE WHEN {measure(cut('ion'))} > 1 "
           f"AND right({cut('ion')}, 1) IN ('s', 't') THEN {cut('ion')} ELSE w END")
    return f"""words AS (SELECT DISTINCT unnest(string_split({cleaned}, ' ')) AS tok FROM {src}),
p0 AS (SELECT tok, tok AS w, CASE tok {odd} ELSE CASE WHEN length(tok) <= 2 THEN tok END END AS fixed FROM words),
p1 AS (SELECT tok, fixed, CASE WHEN ends_with(w, 'sses') THEN {cut('es')}
    WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) = 4 THEN {cut('s')} ELSE {cut('es')} END
    WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {cut('s')} ELSE w END AS w FROM p0),
p2 AS (SELECT tok, fixed, w,
    CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
         WHEN ends_with(w, 'ed') AND contains({shape(cut('ed'))}, 'V') THEN {cut('ed')}
         WHEN NOT ends_with(w, 'ed') AND ends_with(w, 'ing') AND contains({shape(cut('ing'))}, 'V') THEN {cut('ing')} END AS bare FROM p1),
p3 AS (SELECT tok, fixed, CASE
    WHEN bare IS NOT NULL THEN CASE WHEN regexp_matches(bare, '(at|bl|iz)$') THEN bare || 'e'
      WHEN length(bare) >= 2 AND right(bare, 1) = left(right(bare, 2), 1) AND right({shape('bare')}, 1) = 'C'
        AND right(bare, 1) NOT IN ('l', 's', 'z') THEN left(bare, length(bare) - 1)
      WHEN {measure('bare')} = 1 AND {cvc('bare')} THEN bare || 'e' ELSE bare END
    WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {cut('d')} ELSE {cut('ed')} END
    WHEN ends_with(w, 'eed') AND {measure(cut('eed'))} > 0 THEN {cut('d')} ELSE w END AS w FROM p2),
p4 AS (SELECT tok, fixed, CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({shape(cut('y'))}, 1) = 'C'
    THEN {cut('y')} || 'i' ELSE w END AS w FROM p3),
p5 AS (SELECT tok, fixed, CASE WHEN ends_with(w, 'alli') AND {measure(cut('alli'))} > 0 THEN {cut('li')} ELSE w END AS w FROM p4),
p6 AS (SELECT tok, fixed, {_rules(STEP2, 0, logi)} AS w FROM p5),
p7 AS (SELECT tok, fixed, {_rules(STEP3, 0)} AS w FROM p6),
p8 AS (SELECT tok, fixed, {_rules([(s, '') for s in STEP4 if s != 'ion'], 1, ion)} AS w FROM p7),
p9 AS (SELECT tok, fixed, CASE WHEN ends_with(w, 'e') AND ({measure(cut('e'))} > 1
    OR ({measure(cut('e'))} = 1 AND NOT {cvc(cut('e'))})) THEN {cut('e')} ELSE w END AS w FROM p8),
stems AS (SELECT tok, coalesce(fixed, CASE WHEN ends_with(w, 'll') AND {measure(cut('l'))} > 1 THEN {cut('l')} ELSE w END) AS stem FROM p9)"""
