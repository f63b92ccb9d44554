"""Column expressions; nothing here runs a job or needs a Python worker."""

from tablewright.functions.labels import (  # noqa: F401
    agreement_band,
    confidence_status,
    label_to_sentiment,
    merge_to_binary,
    sentiment_to_label,
)
from tablewright.functions.masks import damaged_text, missing, short_text  # noqa: F401
from tablewright.functions.scalars import (  # noqa: F401
    entropy,
    half_even,
    margin,
    month_of,
    parse_day,
    percent,
    safe_log1p,
    to_double,
    to_long,
    value_band,
)
from tablewright.functions.text import (  # noqa: F401
    first_token,
    keyword_hits,
    ngrams,
    preview,
    search_query,
    split_list,
    tokens,
    trim_blank,
    with_terms,
    word_count,
    words,
)
