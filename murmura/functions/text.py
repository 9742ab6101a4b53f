"""Column expressions over text. Everything stays in the JVM: no Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# English, French and site words that never count as keywords.
STOPWORDS = frozenset(
    """
    the a an in on at for to of is are was were be been and or but if then else when where why
    how all any both each few more most other some such no nor not only own same so than too very
    s t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven
    isn ma mightn mustn needn shan shouldn wasn weren won wouldn i me my myself we our ours
    ourselves you your yours yourself yourselves he him his himself she her hers herself it its
    itself they them their theirs themselves what which who whom this that these those
    le la les de des du un une et est pour en que qui dans sur pas plus par avec ce ces cette ont
    il ils elle elles nous vous je tu mon ton son ma ta sa mes tes ses notre votre leur nos vos
    leurs aux ou où donc or ni car mais
    http https com www reddit removed deleted
    """.split()
)

# A Python \w is a letter, a number or an underscore. Java's own \w is ASCII
# only, and its Unicode variant also takes combining marks and joiners.
_WORD = r"[\p{L}\p{N}_]"


def clean_text(text: Column) -> Column:
    """Missing text as '', lower case, no leading or trailing white space."""
    return F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WHITESPACE))


def post_text(*parts: Column) -> Column:
    """Title and body joined by one space; a missing part contributes nothing."""
    return F.concat_ws(" ", *parts)


def tokens(text: Column, min_length: int = 1) -> Column:
    """All lower-case words of at least ``min_length`` code points, in text order.

    A run of word characters is matched whole, so asking the pattern for the
    minimum length drops exactly the words that are too short.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(f"{_WORD}{{{min_length},}}"), F.lit(0))


def not_stopword(word: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    return ~word.isin(sorted(stopwords))


def latin1_fold(text: Column) -> Column:
    """Replace each code point above U+00FF by a question mark."""
    return F.regexp_replace(text.cast("string"), r"[^\x{0}-\x{FF}]", "?")


def report_title(title: Column, width: int = 75) -> Column:
    """Latin-1 title for a report table, shortened when the raw one is longer than ``width``."""
    folded = latin1_fold(title)
    return F.when(
        F.length(title) > width, F.concat(F.substring(folded, 1, width), F.lit("..."))
    ).otherwise(folded)


def csv_field(value: Column) -> Column:
    """One CSV field: quoted only when needed, quotes doubled, missing as empty."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\\r\\n]'), quoted).otherwise(text)


def csv_line(*values: Column) -> Column:
    return F.concat_ws(",", *[csv_field(v) for v in values])
