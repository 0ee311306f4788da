"""Metric name -> implementation.

Each implementation returns ``("aggs", [(metric, sub_metric, aggregate Column)])``
(fusable into one ``agg``), ``("prf", (which, average, zero_division))`` (shares
one confusion table per option set) or ``("frame", metrics_long DataFrame)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import classification as C
from . import corpus as K
from . import scored as S

METRICS: dict = {}

#: Metrics that read the rows in a pass of their own.
FRAMES = {"distinct_ngram", "word_entropy", "pearson", "pearson_correlation", "spearman", "spearman_correlation", "bleu", "rouge",
          "sequence_labeling", "seqeval", "custom_script", "custom", "bertscore", "token_match"}


def register(*names: str):
    def deco(fn):
        for n in names:
            METRICS[n.lower()] = fn
        return fn
    return deco


@register("accuracy")
def _acc(df, keys, pred, label, **o):
    return "aggs", [("accuracy", "", C.accuracy_expr(df, pred, label))]


@register("exact_match")
def _em(df, keys, pred, label, **o):
    return "aggs", [("exact_match", "", C.exact_match_expr(pred, label, **o))]


def _prf(which):
    def impl(df, keys, pred, label, average="weighted", zero_division=0.0, **o):
        return "prf", (which, average, float(zero_division))
    return impl


register("precision")(_prf("precision"))
register("recall")(_prf("recall"))
register("f1_score", "f1")(_prf("f1"))


@register("perplexity")
def _ppl(df, keys, pred, label, **o):
    return "aggs", [("perplexity", "", S.perplexity_expr(pred))]


@register("jaccard", "jaccard_similarity")
def _jac(df, keys, pred, label, ngram=1, normalize=False, **o):
    return "aggs", [("jaccard", "", S._avg0(S.jaccard_score(pred, label, ngram, normalize)))]


@register("semantic_similarity")
def _sem(df, keys, pred, label, metric_type="cosine", **o):
    return "aggs", [("semantic_similarity", "", S._avg0(S.vector_similarity(pred, label, metric_type)))]


@register("factual_consistency")
def _fact(df, keys, pred, label, score_col="qa_score", consistency_threshold=None, **o):
    return "aggs", [("factual_consistency", "", S._avg0(S.factual_score(score_col, consistency_threshold)))]


@register("toxicity")
def _tox(df, keys, pred, label, classes_col="toxicity_classes", target_label="TOXICITY", **o):
    t = str(target_label).upper()
    return "aggs", [("toxicity", t.lower(), S._avg0(S.toxicity_score(classes_col, t)))]


@register("score_average")
def _savg(df, keys, pred, label, score_col="score", name="score_average", **o):
    return "aggs", [(name, "", S._avg0(F.col(score_col).cast("double")))]


@register("novelty")
def _nov(df, keys, pred, label, novelty_ngram_size=2, **o):
    return "aggs", [("novelty", "novelty_score_avg", S._avg0(S.novelty_score(pred, label, novelty_ngram_size)))]


@register("avg_prediction_length", "average_prediction_length")
def _avglen(df, keys, pred, label, result_key_name="avg_prediction_length", **o):
    st = S.is_struct_col(df, pred)
    wc = S.word_count(pred, st)
    cond = F.col(pred).isNotNull()
    # the result key is configurable, but with no rows the fixed key is reported
    val = F.coalesce(F.avg(F.when(cond, wc)), F.lit(0.0))
    return "aggs", [("avg_prediction_length", result_key_name, val)]


@register("keyword_match")
def _kw(df, keys, pred, label, keywords_to_match=None, **o):
    st = S.is_struct_col(df, pred)
    hit = S.keyword_hit(pred, keywords_to_match, st)
    return "aggs", [("keyword_match", "keyword_match_count", F.coalesce(F.sum(hit), F.lit(0.0))),
                    ("keyword_match", "keyword_match_ratio", F.coalesce(F.avg(hit), F.lit(0.0)))]


@register("distinct_ngram")
def _dn(df, keys, pred, label, ngrams=(1, 2), **o):
    return "frame", K.metric_distinct_ngram(df, keys, pred, label, ngrams)


@register("word_entropy")
def _we(df, keys, pred, label, **o):
    return "frame", K.metric_word_entropy(df, keys, pred, label)


@register("pearson", "pearson_correlation")
def _pe(df, keys, pred, label, **o):
    return "frame", K.metric_pearson(df, keys, pred, label)


@register("spearman", "spearman_correlation")
def _sp(df, keys, pred, label, **o):
    return "frame", K.metric_spearman(df, keys, pred, label)


from . import overlap as O  # noqa: E402


@register("bleu")
def _bleu(df, keys, pred, label, weights=(0.25, 0.25, 0.25, 0.25), smoothing="method1", order=(), **o):
    return "frame", O.metric_bleu(df, keys, pred, label, weights, smoothing, order)


@register("rouge")
def _rouge(df, keys, pred, label, metrics=("rouge-l",), stats=("f",), **o):
    return "frame", O.metric_rouge(df, keys, pred, label, metrics, stats)


from . import sequence as Sq  # noqa: E402


@register("sequence_labeling", "seqeval")
def _seq(df, keys, pred, label, item="item_id", pos="pos", average_type="micro avg", arrays=None,
         mode="default", scheme=None, **o):
    # the usual input is one tag list per item; long rows have the item and the position beside the tags
    return "frame", Sq.metric_sequence_labeling(df, keys, item, pos, label, pred, average_type, mode, scheme)


from . import custom as Cu  # noqa: E402
from . import meteor as Me  # noqa: E402
from . import vectors as Ve  # noqa: E402


@register("bertscore", "token_match")
def _tm(df, keys, pred, label, idf=False, pred_tokens="prediction_tokens", label_tokens="label_tokens", item="item_id", **o):
    return "frame", Ve.metric_token_match(df, keys, pred, label, idf, pred_tokens, label_tokens, item)


@register("meteor")
def _met(df, keys, pred, label, alpha=0.9, beta=3.0, gamma=0.5, stem=Me.porter_stem, synonyms=None, item="item_id", **o):
    if synonyms is not None:
        return "frame", Me.metric_meteor(df, keys, pred, label, synonyms, item, alpha=alpha, beta=beta, gamma=gamma, stem=stem)
    return "aggs", [("meteor", "", F.coalesce(F.avg(Me.meteor_scores(pred, label, alpha, beta, gamma, stem)), F.lit(0.0)))]


@register("custom_script", "custom")
def _cust(df, keys, pred, label, init=None, update=None, result=None, merge=None, name="custom", options=None, **o):
    out = Cu.metric_custom(df, init, update, result, merge, keys, pred, label, options or o, name)
    # the error text stays with its row, in the place of the sub-metric
    text = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.col("error"))).otherwise(F.col("sub_metric"))
    return "frame", out.withColumn("sub_metric", text).drop("error")
