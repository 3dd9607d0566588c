"""Row-local recodes as Column builders. Nothing here shuffles or leaves the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The household questionnaire's recodes. Results depend on them.
REFERENCE_YEAR = 2026
AGE_CUTS = (35, 45)
MARRIAGE_AGE_CUT = 18
EXPERIENCE_YEARS_CUT = 1
GRADE_KEYWORDS = (
    (r"(?iu)thpt|trung\s*học\s*phổ\s*thông", 12),
    (r"(?iu)thcs|trung\s*học\s*cơ\s*sở", 9),
    (r"(?iu)tiểu\s*học", 5),
)
ETHNICITY_SPELLINGS = {
    "h'mong": "Mông",
    "h'mông": "Mông",
    "hmong": "Mông",
    "hmông": "Mông",
    "mong": "Mông",
    "mông": "Mông",
    "dao đỏ": "Dao",
    "dao do": "Dao",
}
# A code of the form, taken as it is; other spellings of the word pass through.
ETHNICITY_CODES = {"kinh": "Kinh"}
YES_NO = {"co": True, "khong": False}
INCOME_SHARE_LEVELS = ("duoi_25", "25_50", "51_75", "tren_75")
REVIEW_FLAG = "needs_review"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_numeric(value: Column | str) -> Column:
    """Number or NULL; text that is no number, and NaN, become NULL."""
    number = _col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_int(text: Column | str) -> Column:
    """Whole-string integers only; booleans written as text, ranges and decimals are NULL."""
    trimmed = F.trim(_col(text).cast("string"))
    return F.when(trimmed.rlike(r"^-?[0-9]+$"), trimmed.try_cast("bigint"))


def safe_float(text: Column | str) -> Column:
    """Text to double, NULL for anything that is not one number."""
    trimmed = F.trim(_col(text).cast("string"))
    return F.when(trimmed.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), trimmed.try_cast("double"))


def age_from_year(birth_year: Column | str, reference_year: int = REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - safe_int(birth_year)


def numeric_bracket(value: Column | str, cuts: Sequence[float], labels: Sequence[str], closed: str = "left") -> Column:
    """Label by cut points. closed='left' puts a value equal to a cut in the upper bracket,
    'right' in the lower one; a sequence of sides gives one side per cut."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("labels must outnumber cuts by one")
    sides = [closed] * len(cuts) if isinstance(closed, str) else list(closed)
    number = _col(value)
    bracket = F.when(number.isNull(), F.lit(None).cast("string"))
    for cut, side, label in zip(cuts, sides, labels):
        bracket = bracket.when(number < cut if side == "left" else number <= cut, F.lit(label))
    return bracket.otherwise(F.lit(labels[-1]))


def age_bracket(age: Column | str) -> Column:
    low, high = AGE_CUTS
    return numeric_bracket(age, AGE_CUTS, (f"<{low}", f"{low}-{high}", f">{high}"), closed=("left", "right"))


def marriage_age_bracket(text: Column | str) -> Column:
    cut = MARRIAGE_AGE_CUT
    return numeric_bracket(safe_int(text), (cut,), (f"<{cut}", f">={cut}"))


def qualitative_bound(text: Column | str, cut: float = EXPERIENCE_YEARS_CUT) -> Column:
    """'>1'-style answers: the upper label when the stated bound reaches the cut, else NULL."""
    bound = safe_float(F.regexp_extract(F.trim(_col(text).cast("string")), r"^>(.*)$", 1))
    return F.when(bound >= cut, F.lit(f">={cut}"))


def experience_bracket(text: Column | str) -> Column:
    cut = EXPERIENCE_YEARS_CUT
    raw = _col(text).cast("string")
    return F.when(F.trim(raw).startswith(">"), qualitative_bound(raw, cut)).otherwise(
        numeric_bracket(safe_float(raw), (cut,), (f"<{cut}", f">={cut}"))
    )


def grade_from_text(text: Column | str, keywords: Sequence[tuple[str, int]] = GRADE_KEYWORDS) -> Column:
    """First integer written in the text, else the level its first matching keyword stands for."""
    raw = _col(text)
    digits = F.regexp_extract(raw, r"[0-9]+", 0)
    from_words = [F.when(raw.rlike(pattern), F.lit(grade)) for pattern, grade in keywords]
    return F.coalesce(F.when(digits != "", digits.try_cast("int")), *from_words)


def education_bracket(text: Column | str, never_schooled: Column | None = None, vocational: Column | None = None) -> Column:
    """Ticked boxes outrank the written grade; a level counts only once completed."""
    grade = grade_from_text(text)
    never = F.coalesce(never_schooled, F.lit(False)) if never_schooled is not None else F.lit(False)
    trained = F.coalesce(vocational, F.lit(False)) if vocational is not None else F.lit(False)
    return (
        F.when(trained, "thpt").when(never, "khong_di_hoc").when(grade >= 12, "thpt").when(grade >= 9, "thcs")
        .when(grade.isNotNull(), "tieu_hoc")
    )


def mapped(value: Column | str, mapping: Mapping) -> Column:
    """Lookup in a small literal map; values outside it become NULL."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), _col(value))


def spelling_normalise(value: Column | str, spellings: Mapping[str, str] = ETHNICITY_SPELLINGS, codes: Mapping[str, str] = ETHNICITY_CODES) -> Column:
    """Codes by their exact text, known variants to one spelling, ignoring case and outer blanks; others pass
    through trimmed."""
    trimmed = F.trim(_col(value))
    return F.coalesce(mapped(trimmed, codes), mapped(F.lower(trimmed), spellings), trimmed)


def yes_no_bool(value: Column | str, mapping: Mapping[str, bool] = YES_NO) -> Column:
    return mapped(value, mapping)


def ordinal_map(value: Column | str, levels: Sequence[str] = INCOME_SHARE_LEVELS) -> Column:
    """Position 1..k of an ordered level; combos and unknown text are NULL."""
    return mapped(value, {level: rank for rank, level in enumerate(levels, start=1)})


def strip_suffix(text: Column | str, pattern: str = r"-[0-9]+phieu$") -> Column:
    return F.regexp_replace(_col(text), pattern, "")


def as_code_list(codes: Column | str) -> Column:
    """NULL to [], NULL members dropped."""
    return F.filter(F.coalesce(_col(codes), F.array().cast("array<string>")), lambda code: code.isNotNull())


def as_single_category(codes: Column | str, separator: str = "+") -> Column:
    """Several marks on a single-choice field become one sorted combo; none becomes NULL."""
    kept = F.array_sort(as_code_list(codes))
    return F.when(F.size(kept) > 0, F.array_join(kept, separator))


def other_text_override(code: Column | str, written: Column | str, other_code: str = "khac") -> Column:
    code = _col(code)
    return F.when(code == other_code, F.coalesce(F.nullif(_col(written), F.lit("")), code)).otherwise(code)


def _codes_literal(codes: Sequence[str]) -> Column:
    return F.array(*[F.lit(code) for code in codes])


def combo_split(value: Column | str) -> Column:
    return F.split(_col(value), r"\+")


def combo_parts(value: Column | str, known: Sequence[str] | Column) -> Column:
    """The members of 'a+b' when each is a known code, otherwise the value alone."""
    value = _col(value)
    known = known if isinstance(known, Column) else _codes_literal(known)
    parts = combo_split(value)
    is_combo = value.contains("+") & F.forall(parts, lambda part: F.array_contains(known, part))
    return F.when(is_combo, parts).otherwise(F.array(value))


def combo_has(value: Column | str, codes: Sequence[str], null_as: bool | None = None) -> Column:
    """Does the value, or any member of a combo, belong to codes? NULL stays NULL unless null_as is given."""
    hit = F.arrays_overlap(combo_split(value), _codes_literal(codes))
    return hit if null_as is None else F.coalesce(hit, F.lit(null_as))


def any_of_indicators(*columns: Column | str) -> Column:
    """OR of 0/1 columns; a missing indicator counts as not ticked."""
    ticked = F.lit(False)
    for column in columns:
        ticked = ticked | F.coalesce(_col(column) == 1, F.lit(False))
    return ticked


def base_question(column: Column | str, overrides: Mapping[str, str] | None = None) -> Column:
    """The question a wide column came from, such as Q14 for Q14_row."""
    name = _col(column)
    stem = F.regexp_extract(name, r"^([A-Za-z]+[0-9]+[a-c]?)", 1)
    found = F.when(stem != "", stem).otherwise(name)
    return F.coalesce(mapped(name, overrides), found) if overrides else found


def canonical_codes(codes: Column | str, allowed: Column | Sequence[str]) -> Column:
    """Match codes to the contract ignoring case: known ones in contract order, then unknown ones as read."""
    allowed = allowed if isinstance(allowed, Column) else _codes_literal(allowed)
    raw = F.array_distinct(_col(codes))
    lowered = F.transform(raw, lambda code: F.lower(code))
    known = F.filter(allowed, lambda code: F.array_contains(lowered, F.lower(code)))
    return F.concat(known, invalid_codes(raw, allowed))


def invalid_codes(codes: Column | str, allowed: Column | Sequence[str]) -> Column:
    allowed = allowed if isinstance(allowed, Column) else _codes_literal(allowed)
    allowed_lower = F.transform(allowed, lambda code: F.lower(code))
    return F.filter(F.array_distinct(_col(codes)), lambda code: ~F.array_contains(allowed_lower, F.lower(code)))


def flags_of(flags: Column | str) -> Column:
    return F.array_distinct(F.coalesce(_col(flags), F.array().cast("array<string>")))


def add_flag(flags: Column | str, flag: str, condition: Column | None = None) -> Column:
    flags = flags_of(flags)
    added = F.array_union(flags, F.array(F.lit(flag)))
    return added if condition is None else F.when(condition, added).otherwise(flags)


def remove_flag(flags: Column | str, flag: str) -> Column:
    return F.array_remove(flags_of(flags), flag)


def note_concat(*notes: Column) -> Column:
    """Non-empty notes joined by '; ', NULL when there are none."""
    kept = [F.nullif(note, F.lit("")) for note in notes]
    return F.nullif(F.concat_ws("; ", *kept), F.lit(""))


def page_note_merge(first: Column | str, second: Column | str) -> Column:
    """First non-empty page note; a differing second one is appended in brackets."""
    one, two = F.nullif(_col(first), F.lit("")), F.nullif(_col(second), F.lit(""))
    return F.when(one != two, F.concat(one, F.lit(" [second read: "), two, F.lit("]"))).otherwise(F.coalesce(one, two))


def is_safe_identifier(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(r"^[A-Za-z0-9_-]+$"), F.lit(False))


def safe_identifier(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"[^A-Za-z0-9_-]", "_")


def needs_review(flags: Column | str, marked: Column | str | None = None) -> Column:
    """Still awaiting review, in either the boolean or the flag-list form."""
    flagged = F.coalesce(F.array_contains(_col(flags), REVIEW_FLAG), F.lit(False))
    return flagged if marked is None else F.coalesce(_col(marked), F.lit(False)) | flagged


def provenance_columns(schema_version: str, authored_by: str, purpose: str) -> dict[str, Column]:
    """Columns for withColumns: who produced the record, under which contract, and when (UTC ISO text)."""
    now_utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return {
        "schema_version": F.lit(schema_version),
        "authored_by": F.lit(authored_by),
        "purpose": F.lit(purpose),
        "extracted_at": F.date_format(now_utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
    }
