from marquee.operators.alerts import low_rated_absolute, low_rated_relative
from marquee.operators.cleaning import cleaning_report, drop_missing, fill_missing
from marquee.operators.features import (
    CategoryMeans,
    encode_by_label,
    assemble_features,
    assembler,
    category_ranks,
    category_stages,
    check_category_bound,
    hashed_categories,
    index_category,
    one_hot,
)
from marquee.operators.ranks import ranks
from marquee.operators.regression import (
    feature_importance,
    fit_regressor,
    predict,
    r2_score,
    slot_widths,
    split_train_test,
)
from marquee.operators.reshape import (
    dedup_by_key,
    dedup_rows,
    drop_repeats,
    enrich_left,
    explode_tags,
    heavy_buckets,
    measured_bytes,
    top_n,
)
from marquee.operators.stats import agg_distinct, agg_exact_mean, agg_first, agg_mean, agg_stddev, daily_average
from marquee.operators.text import (
    counted_terms,
    fit_topics,
    fit_vocabulary,
    remove_stopwords,
    term_counts,
    term_vectors,
    tokenize,
    topic_mixture,
    vector_entries,
)

from marquee.operators.topics import TopicTable, fit_topic_table, topic_shares, topic_terms

__all__ = [
    "CategoryMeans",
    "TopicTable",
    "encode_by_label",
    "fit_topic_table",
    "topic_shares",
    "topic_terms",
    "agg_distinct",
    "agg_exact_mean",
    "agg_first",
    "agg_mean",
    "agg_stddev",
    "assemble_features",
    "assembler",
    "category_ranks",
    "category_stages",
    "check_category_bound",
    "cleaning_report",
    "daily_average",
    "dedup_by_key",
    "dedup_rows",
    "drop_repeats",
    "drop_missing",
    "enrich_left",
    "explode_tags",
    "counted_terms",
    "feature_importance",
    "fill_missing",
    "fit_regressor",
    "fit_topics",
    "fit_vocabulary",
    "hashed_categories",
    "heavy_buckets",
    "index_category",
    "low_rated_absolute",
    "low_rated_relative",
    "measured_bytes",
    "one_hot",
    "predict",
    "r2_score",
    "ranks",
    "remove_stopwords",
    "slot_widths",
    "split_train_test",
    "term_counts",
    "term_vectors",
    "tokenize",
    "top_n",
    "topic_mixture",
    "vector_entries",
]
