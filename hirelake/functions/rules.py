"""Rule extractor: free text -> the five fields of the extraction contract.

One possible extractor; any model function can take its place (``operators.contract.extract_with``).
Rules read the whole text. One pass reduces a text to the words that occur in any phrase, with a dot
for every run of other words; the rules are then substring tests on that short rest.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas as S
from hirelake.functions.text import col, tokens

# --- fixed values: phrases, first rule that matches wins --------------------------
# Whole words, any punctuation between them.

CERTIFICATE_PHRASES = [
    "ielts", "toeic", "toefl", "excellent english", "excellent in english", "fluent english", "fluent in english",
    "proficient english", "proficient in english",
]
COMMUNICATION_PHRASES = ["english communication", "english speaking", "english conversation", "spoken english"]
COMMUNICATION_SENTENCE = r"communicat[^.\n]*english"
ENGLISH_PHRASE = "english"

LEVEL_RULES = [
    ("Intern", ["intern", "internship"]),
    ("Fresher", ["fresher"]),
    ("Director", ["director", "cto", "head of"]),
    ("Manager", ["manager", "team lead", "leader"]),
    ("Senior", ["senior", "sr"]),
    ("Middle", ["middle", "mid level"]),
    ("Junior", ["junior", "jr"]),
]

ROLE_RULES = [
    ("Data Engineer", ["data engineer", "data engineers", "data engineering", "etl", "data platform", "analytics engineer"]),
    ("AI/Machine Learning", ["machine learning", "ai engineer", "deep learning", "mlops", "nlp"]),
    ("Data Scientist", ["data scientist", "data science"]),
    ("Data/Business Analyst", ["data analyst", "business analyst", "business intelligence", "bi analyst"]),
    ("Fullstack", ["fullstack", "full stack"]),
    ("Frontend", ["frontend", "front end"]),
    ("Backend", ["backend", "back end"]),
    ("Mobile", ["mobile", "android", "ios", "flutter"]),
    ("QA/QC/Tester", ["qa", "qc", "tester", "test engineer"]),
    ("DevOps/Cloud", ["devops", "sre", "cloud engineer"]),
    ("System Admin", ["system admin", "system administrator", "sysadmin", "network engineer"]),
    ("UI/UX Designer", ["ui ux", "ux", "ui designer", "product designer"]),
    ("Security", ["security", "pentest", "pentester", "pentesting"]),
    ("Scrum Master", ["scrum master"]),
    ("Product Owner/Manager", ["product owner", "product manager", "project manager"]),
]

# lower bound of '3 years', '3+ yrs', '3-5 years', '3 to 5 years'
YEARS = (
    r"(?:^|[^\p{L}\p{N}])(\d{1,2})\s*(?:\+|(?:-|–|to)\s*\d{1,2}\s*\+?)?\s*(?:years?|yrs?)(?:$|[^\p{L}\p{N}])"
)
SKILL_TOKEN = r"\.?[\p{L}\p{N}+#]+(?:\.[\p{L}\p{N}+#]+)*"


KEYWORDS = sorted(
    {
        word
        for phrases in [
            CERTIFICATE_PHRASES,
            COMMUNICATION_PHRASES,
            [ENGLISH_PHRASE],
            *[p for _, p in LEVEL_RULES + ROLE_RULES],
        ]
        for phrase in phrases
        for word in phrase.split()
    }
)


def prepared(df: DataFrame, title: Column | str, body: Column | str) -> DataFrame:
    """Add the three forms the rules read, as columns, so that each is computed once per row.

    ``__title`` and ``__body``: ' keywords and . dots between single blanks '; ``__low``: both texts
    in lower case. Spark keeps a projection of its own for columns that are costly and used
    repeatedly.
    """

    def reduced(c: Column | str) -> Column:
        kept = F.transform(tokens(c), lambda w: F.when(w.isin(*KEYWORDS), w).otherwise(F.lit(".")))
        line = F.concat(F.lit(" "), F.coalesce(F.array_join(kept, " "), F.lit("")), F.lit(" "))
        return F.regexp_replace(line, r"( \.)+", " .")

    low = F.lower(F.concat_ws("\n", col(title), col(body)))
    return df.withColumns({"__title": reduced(title), "__body": reduced(body), "__low": low})


def needle(phrase: str) -> str:
    """The substring of a prepared text that stands for a phrase."""
    return f" {phrase} "


def _any(phrases: list[str], *texts: str) -> Column:
    return reduce(or_, [F.col(t).contains(needle(p)) for p in phrases for t in texts])


def _first_rule(rules: list[tuple[str, list[str]]]) -> Column:
    """Title first, then the description."""
    whens = [F.when(_any(phrases, t), F.lit(v)) for t in ("__title", "__body") for v, phrases in rules]
    return F.coalesce(*whens, F.lit(S.UNKNOWN))


def min_years() -> Column:
    """Lower bound of the first 'N years' / 'N-M years'; months or nothing give 0."""
    low = F.col("__low")
    found = F.regexp_extract(low, YEARS, 1).try_cast("int")
    return F.when(low.contains("year") | low.contains("yr"), F.coalesce(found, F.lit(0))).otherwise(F.lit(0))


def english_level() -> Column:
    both = ("__title", "__body")
    english = _any([ENGLISH_PHRASE], *both)
    sentence = english & F.col("__low").rlike(COMMUNICATION_SENTENCE)
    return (
        F.when(_any(CERTIFICATE_PHRASES, *both), S.ENGLISH_CERTIFICATE)
        .when(_any(COMMUNICATION_PHRASES, *both) | sentence, S.ENGLISH_COMMUNICATION)
        .when(english, S.ENGLISH_READING)
        .otherwise(S.ENGLISH_NONE)
    )


def job_role() -> Column:
    return _first_rule(ROLE_RULES)


def stated_level() -> Column:
    return _first_rule(LEVEL_RULES)


def level_from_years(level: Column | str, years: Column | str) -> Column:
    """Fill an 'Unknown' level from the years; negative or missing years leave it alone."""
    level, years = col(level), col(years)
    guess = (
        F.when(years == 0, "Fresher")
        .when(years.between(1, 2), "Junior")
        .when(years.between(3, 4), "Middle")
        .when(years >= 5, "Senior")
        .otherwise(level)
    )
    return F.when(level == S.UNKNOWN, guess).otherwise(level)


def known_skills(limit: int | None = None) -> Column:
    """Canonical names of the built-in skills, by first appearance, all or at most ``limit``.

    The vocabulary is a literal, so no join and no shuffle; table-sized dictionaries go through
    ``operators.contract.skills_from_dictionary``.
    """
    canonical = {a: name for name, aliases in S.SKILL_ALIASES.items() for a in aliases}
    found = F.regexp_extract_all("__low", F.lit(f"({SKILL_TOKEN})"), 1)
    hits = F.array_distinct(F.filter(found, lambda w: w.isin(*canonical)))
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(canonical.items())])
    found = F.array_distinct(F.transform(hits, lambda a: names[a]))
    return found if limit is None else F.slice(found, 1, limit)


def record() -> Column:
    """The whole extraction record of a prepared row as one struct."""
    return F.struct(
        min_years().alias("min_years_of_experience"),
        known_skills(S.MAX_SKILLS).alias("core_tech_stack"),
        english_level().alias("english_requirement"),
        job_role().alias("job_role"),
        level_from_years(stated_level(), min_years()).alias("job_level"),
    )
