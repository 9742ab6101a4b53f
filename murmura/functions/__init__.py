from murmura.functions.casting import (
    in_order_desc,
    nan_to_null,
    number,
    to_double,
    to_int,
)
from murmura.functions.sentiment import (
    is_negative,
    is_neutral,
    is_positive,
    keyword_sentiment,
)
from murmura.functions.text import (
    STOPWORDS,
    clean_text,
    csv_field,
    csv_line,
    latin1_fold,
    not_stopword,
    post_text,
    report_title,
    tokens,
)
from murmura.functions.time import epoch_to_utc, hour_bucket, utc, with_dates

__all__ = [
    "STOPWORDS",
    "clean_text",
    "csv_field",
    "csv_line",
    "epoch_to_utc",
    "hour_bucket",
    "in_order_desc",
    "is_negative",
    "is_neutral",
    "is_positive",
    "keyword_sentiment",
    "latin1_fold",
    "nan_to_null",
    "not_stopword",
    "number",
    "post_text",
    "report_title",
    "to_double",
    "to_int",
    "tokens",
    "utc",
    "with_dates",
]
