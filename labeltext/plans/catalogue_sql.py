"""DuckDB SQL that must give the same rows as each query of the catalogue. Written straight
from the definitions, with plain windows and joins, over the whole tables."""

from __future__ import annotations

# The same character classes as in the Spark expressions, in RE2 spelling.
WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]+"
)
TOKEN = r"[\p{L}\p{N}_]{2,}"


def clean(text: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({text}, '')), '{WS}', ' ', 'g'))"


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{WS}', ''), '{WS}$', '')"


def tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN}')"


# ---- shared table expressions: name -> (definition, names it needs) ---------------------

CTE: dict[str, tuple[str, list[str]]] = {
    "corpus": (
        "SELECT d.doc_id AS raw_index, d.text AS text_combined, d.source, "
        "CAST(l.toxic AS BIGINT) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
        [],
    ),
    "ranked": (
        "SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || raw_index), "
        "raw_index) AS rank, count(*) OVER (PARTITION BY label) AS n FROM corpus",
        ["corpus"],
    ),
    "phased": (
        "SELECT raw_index, text_combined, source, label, CASE "
        "WHEN rank <= round_even(n * 0.6::DOUBLE, 0) THEN 'phase1_reference' "
        "WHEN rank <= round_even(n * 0.8::DOUBLE, 0) THEN 'phase2_increment' "
        "ELSE 'phase3_holdout' END AS phase FROM ranked",
        ["ranked"],
    ),
    "four_phases": (
        "SELECT raw_index, label, phase FROM phased UNION ALL "
        "SELECT raw_index, label, 'phase2_sample' FROM phased WHERE phase <> 'phase3_holdout'",
        ["phased"],
    ),
    "sliced": (
        "SELECT raw_index, text_combined, source, label, phase AS slice FROM phased "
        "WHERE phase <> 'phase3_holdout'",
        ["phased"],
    ),
    "cleaned": (
        f"SELECT min(raw_index) AS raw_index, t AS text_combined, label FROM (SELECT raw_index, "
        f"label, {clean('text_combined')} AS t FROM corpus) WHERE length(t) >= 3 GROUP BY t, label",
        ["corpus"],
    ),
    "sample": (
        f"SELECT min(raw_index) AS raw_index, t AS text_combined, label FROM (SELECT raw_index, "
        f"label, {clean('text_combined')} AS t FROM phased WHERE phase <> 'phase3_holdout') "
        "WHERE length(t) >= 3 GROUP BY t, label",
        ["phased"],
    ),
    "sizes": (
        "SELECT total, n_holdout, total - n_holdout AS n_train, "
        "CAST(ceil(n_holdout * (0.15::DOUBLE / (0.15::DOUBLE + 0.15::DOUBLE))) AS BIGINT) AS "
        "n_test FROM (SELECT count(*) AS total, CAST(ceil(count(*) * (0.15::DOUBLE + "
        "0.15::DOUBLE)) AS BIGINT) AS n_holdout FROM sample)",
        ["sample"],
    ),
    "quota_train": (
        "SELECT label, n, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, label) "
        "<= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS q_train, n_holdout, n_test FROM "
        "(SELECT label, n, n / total::DOUBLE * n_train AS share, "
        "floor(n / total::DOUBLE * n_train) AS base, n_train, n_holdout, n_test FROM "
        "(SELECT label, count(*) AS n FROM sample GROUP BY label), sizes)",
        ["sizes"],
    ),
    "quota": (
        "SELECT label, q_train, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, "
        "label) <= n_val - sum(base) OVER () THEN 1 ELSE 0 END AS q_val FROM "
        "(SELECT label, q_train, n_holdout - n_test AS n_val, "
        "(n - q_train) / n_holdout::DOUBLE * (n_holdout - n_test) AS share, "
        "floor((n - q_train) / n_holdout::DOUBLE * (n_holdout - n_test)) AS base "
        "FROM quota_train)",
        ["quota_train"],
    ),
    "splits": (
        "SELECT raw_index, text_combined, label, CASE WHEN rank <= q_train THEN 'train' "
        "WHEN rank <= q_train + q_val THEN 'val' ELSE 'test' END AS split FROM "
        "(SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || raw_index), "
        "raw_index) AS rank FROM sample) JOIN quota USING (label)",
        ["sample", "quota"],
    ),
    "rules": (
        "SELECT raw_index, label, source, phase, CASE phase WHEN 'phase1_reference' THEN 'train' "
        "WHEN 'phase2_increment' THEN 'val' ELSE 'test' END AS split, model, "
        "CAST(score > lim AS BIGINT) AS prediction, score FROM ("
        "SELECT *, 'length_rule' AS model, length(text_combined) / 1000.0::DOUBLE AS score, "
        "2.0 AS lim FROM phased UNION ALL "
        "SELECT *, 'digit_rule', (length(text_combined) - length(regexp_replace(text_combined, "
        "'[0-9]', '', 'g'))) / greatest(length(text_combined), 1)::DOUBLE, 0.01 FROM phased "
        "UNION ALL "
        "SELECT *, 'upper_rule', (length(text_combined) - length(regexp_replace(text_combined, "
        "'[A-Z]', '', 'g'))) / greatest(length(text_combined), 1)::DOUBLE, 0.02 FROM phased)",
        ["phased"],
    ),
    "cells": (
        "SELECT model, split, count(*) FILTER (label = 0 AND prediction = 0)::DOUBLE AS tn, "
        "count(*) FILTER (label = 0 AND prediction = 1)::DOUBLE AS fp, "
        "count(*) FILTER (label = 1 AND prediction = 0)::DOUBLE AS fn, "
        "count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp FROM rules "
        "GROUP BY model, split",
        ["rules"],
    ),
    "report": (
        "SELECT model, split, (tp + tn) / (tp + tn + fp + fn) AS accuracy, "
        "coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
        "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
        "coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1, "
        "coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) AS f2, "
        "tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive, "
        "coalesce(fp / nullif(fp + tn, 0), 0) AS false_positive_rate, "
        "coalesce(fn / nullif(fn + tp, 0), 0) AS false_negative_rate FROM cells",
        ["cells"],
    ),
    "steps": (
        "SELECT model, split, score, pos, neg, sum(pos) OVER w AS cum_pos, "
        "sum(neg) OVER w AS cum_neg FROM (SELECT model, split, score, "
        "count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM rules "
        "GROUP BY model, split, score) "
        "WINDOW w AS (PARTITION BY model, split ORDER BY score DESC)",
        ["rules"],
    ),
    "ranking": (
        "SELECT model, split, sum(neg * (cum_pos - pos + pos / 2.0::DOUBLE)) / "
        "nullif(sum(pos) * sum(neg), 0) AS roc_auc, "
        "coalesce(sum(pos * (cum_pos / (cum_pos + cum_neg)::DOUBLE)) / nullif(sum(pos), 0), 0) "
        "AS average_precision FROM steps GROUP BY model, split",
        ["steps"],
    ),
    "full_report": (
        "SELECT r.*, k.roc_auc, k.average_precision FROM report r JOIN ranking k "
        "USING (model, split)",
        ["report", "ranking"],
    ),
    "slice_tokens": (
        f"SELECT slice, unnest({tokens('text_combined')}) AS token FROM sliced",
        ["sliced"],
    ),
    "token_pairs": (
        "SELECT token, count(*) FILTER (slice = 'phase1_reference') AS ref_n, "
        "count(*) FILTER (slice = 'phase2_increment') AS cur_n FROM slice_tokens GROUP BY token",
        ["slice_tokens"],
    ),
    "slice_lengths": (
        "SELECT slice, length(text_combined) AS length FROM sliced",
        ["sliced"],
    ),
    "cdf": (
        "SELECT length, sum(r) OVER w / (SELECT count(*) FROM slice_lengths WHERE slice = "
        "'phase1_reference')::DOUBLE AS f1, sum(c) OVER w / (SELECT count(*) FROM slice_lengths "
        "WHERE slice = 'phase2_increment')::DOUBLE AS f2 FROM (SELECT length, "
        "count(*) FILTER (slice = 'phase1_reference') AS r, "
        "count(*) FILTER (slice = 'phase2_increment') AS c FROM slice_lengths GROUP BY length) "
        "WINDOW w AS (ORDER BY length)",
        ["slice_lengths"],
    ),
    "ks": (
        "SELECT max(abs(f1 - f2)) AS d, (SELECT sqrt(a * b / (a + b)::DOUBLE) FROM (SELECT "
        "count(*) FILTER (slice = 'phase1_reference') AS a, "
        "count(*) FILTER (slice = 'phase2_increment') AS b FROM slice_lengths)) AS en FROM cdf",
        ["cdf"],
    ),
    # TF-IDF of the split table, vocabulary from the train split.
    "split_tokens": (
        f"SELECT raw_index, split, label, {tokens('strip_accents(lower(text_combined))')} AS a "
        "FROM splits",
        ["splits"],
    ),
    "split_terms": (
        "SELECT raw_index, split, label, term, count(*) AS tf FROM (SELECT raw_index, split, "
        "label, unnest(a) AS term FROM split_tokens UNION ALL SELECT raw_index, split, label, "
        "unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) "
        "FROM split_tokens) GROUP BY ALL",
        ["split_tokens"],
    ),
    "n_train": ("SELECT count(*) AS n FROM splits WHERE split = 'train'", ["splits"]),
    "vocab": (
        "SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, tf, df, "
        "ln((1.0 + n) / (1.0 + df)::DOUBLE) + 1.0 AS idf FROM (SELECT term, "
        "CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM split_terms WHERE split = 'train' "
        "GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT n FROM n_train) "
        "ORDER BY tf DESC, term LIMIT 20000), n_train",
        ["split_terms", "n_train"],
    ),
    "split_raw": (
        "SELECT raw_index, split, label, term_id, (1.0 + ln(t.tf)) * idf AS weight "
        "FROM split_terms t JOIN vocab v ON t.term = v.term",
        ["split_terms", "vocab"],
    ),
    "split_weights": (
        "SELECT raw_index, split, label, term_id, weight / sqrt(sum(weight * weight) OVER "
        "(PARTITION BY raw_index)) AS weight FROM split_raw",
        ["split_raw"],
    ),
    "nb_mass": (
        "SELECT term_id, sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS m0, "
        "sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS m1 FROM split_weights "
        "WHERE split = 'train' GROUP BY term_id",
        ["split_weights"],
    ),
    "nb": (
        "SELECT term_id, -ln((m1 + 0.5) / sum(m1 + 0.5) OVER ()) AS weight_0, "
        "-ln((m0 + 0.5) / sum(m0 + 0.5) OVER ()) AS weight_1 FROM nb_mass",
        ["nb_mass"],
    ),
    "model": (
        "SELECT v.term, v.idf, nb.weight_1 - nb.weight_0 AS w FROM vocab v JOIN nb USING (term_id)",
        ["vocab", "nb"],
    ),
    "majority": (
        "SELECT label FROM splits WHERE split = 'train' GROUP BY label "
        "ORDER BY count(*) DESC, label LIMIT 1",
        ["splits"],
    ),
}


def scored(name: str, source: str, key: str, text: str, needs: list[str]) -> None:
    """Register ``<name>``: key and margin of every row of ``source`` under the NB model."""
    CTE[f"{name}_tokens"] = (
        f"SELECT {key} AS k, {tokens(f'strip_accents(lower({text}))')} AS a FROM {source}",
        needs,
    )
    CTE[name] = (
        f"SELECT s.{key}, round(coalesce(dot / nullif(len, 0), 0), 12) AS margin FROM {source} s "
        "LEFT JOIN (SELECT k, sum((1.0 + ln(tf)) * idf * w) AS dot, "
        "sqrt(sum((1.0 + ln(tf)) * idf * (1.0 + ln(tf)) * idf)) AS len FROM (SELECT k, term, "
        f"count(*) AS tf FROM (SELECT k, unnest(a) AS term FROM {name}_tokens UNION ALL SELECT k, "
        "unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) "
        f"FROM {name}_tokens) GROUP BY ALL) JOIN model USING (term) GROUP BY k) "
        f"ON k = s.{key}",
        [f"{name}_tokens", "model"],
    )


# Both linear objectives where a weight follows from its term's length and the bias is 1/8.
CTE["point"] = (
    "SELECT term_id, term, (length(term) % 7 - 3) / 8::DOUBLE AS w FROM vocab", ["vocab"]
)
CTE["train_margins"] = (
    "SELECT raw_index, sign, row_weight, sign * (0.125::DOUBLE + coalesce(dot, 0)) AS m FROM "
    "(SELECT raw_index, CASE WHEN label = 1 THEN 1 ELSE -1 END AS sign, count(*) OVER () / "
    "(2.0::DOUBLE * count(*) OVER (PARTITION BY label)) AS row_weight FROM splits "
    "WHERE split = 'train') LEFT JOIN (SELECT raw_index, sum(weight * w) AS dot "
    "FROM split_weights JOIN point USING (term_id) GROUP BY raw_index) USING (raw_index)",
    ["splits", "split_weights", "point"],
)
CTE["slopes"] = (
    "SELECT 'logistic_regression' AS model, raw_index, row_weight * ln(1 + exp(-m)) AS loss, "
    "-row_weight * sign / (1 + exp(m)) AS slope FROM train_margins UNION ALL "
    "SELECT 'linear_svc', raw_index, row_weight * greatest(0, 1 - m) * greatest(0, 1 - m), "
    "-2 * row_weight * sign * greatest(0, 1 - m) FROM train_margins",
    ["train_margins"],
)
CTE["rest"] = ("SELECT * FROM splits WHERE split <> 'train'", ["splits"])
scored("rest_scores", "rest", "raw_index", "text_combined", ["rest"])
scored("slice_scores", "sliced", "raw_index", "text_combined", ["sliced"])
CTE["docs"] = ("SELECT doc_id AS raw_index, text, source FROM documents", [])
scored("doc_scores", "docs", "raw_index", "text", ["docs"])
CTE["holdout"] = (
    f"SELECT * FROM (SELECT raw_index, label, {clean('text_combined')} AS text_combined "
    "FROM phased WHERE phase = 'phase3_holdout') WHERE length(text_combined) >= 3",
    ["phased"],
)
scored("holdout_scores", "holdout", "raw_index", "text_combined", ["holdout"])
CTE["requests"] = (
    "SELECT 'd' || doc_id AS message_id, text FROM documents UNION ALL "
    "SELECT conv_id || '-' || turn, text FROM conversations",
    [],
)


def screened(source: str) -> str:
    return (
        f"SELECT message_id, text, CASE WHEN text IS NULL THEN 'missing' WHEN length(text) < 1 "
        f"THEN 'empty' WHEN length(text) > 50000 THEN 'too_long' WHEN length({strip('text')}) = 0 "
        f"THEN 'blank' WHEN length({clean('text')}) < 3 THEN 'too_short' END AS reject_reason, "
        f"{clean('text')} AS text_combined FROM {source}"
    )


CTE["turns"] = ("SELECT conv_id || '-' || turn AS message_id, text FROM conversations", [])
CTE["accepted"] = (
    f"SELECT * FROM ({screened('turns')}) WHERE reject_reason IS NULL",
    ["turns"],
)
scored("accepted_scores", "accepted", "message_id", "text_combined", ["accepted"])
CTE["spoilt"] = (
    "SELECT conv_id || '-' || turn AS message_id, CASE conv_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '' "
    "WHEN 2 THEN repeat(' ', 4) WHEN 3 THEN substring(text, 1, 2) WHEN 4 THEN "
    "rpad(text, 50001, 'x') ELSE text END AS text FROM conversations",
    [],
)
CTE["spoilt_screened"] = (screened("spoilt"), ["spoilt"])
CTE["spoilt_accepted"] = (
    "SELECT * FROM spoilt_screened WHERE reject_reason IS NULL", ["spoilt_screened"]
)
scored("spoilt_scores", "spoilt_accepted", "message_id", "text_combined", ["spoilt_accepted"])
CTE["holdout_predictions"] = (
    "SELECT 'complement_nb' AS model, label, CAST(margin > 0 AS BIGINT) AS prediction, "
    "1 / (1 + exp(-margin)) AS score FROM holdout JOIN holdout_scores USING (raw_index) UNION ALL "
    "SELECT 'dummy', label, (SELECT label FROM majority), (SELECT label FROM majority)::DOUBLE "
    "FROM holdout",
    ["holdout_scores", "majority", "holdout"],
)


def js(relation: str, key: str) -> str:
    """Distance of the two slices of (slice, key, n)."""
    return (
        f"SELECT sqrt(greatest(0, sum(CASE WHEN p > 0 THEN 0.5 * p * ln(2 * p / (p + q)) ELSE 0 END "
        "+ CASE WHEN q > 0 THEN 0.5 * q * ln(2 * q / (p + q)) ELSE 0 END))) AS js_distance FROM "
        "(SELECT r / nullif(sum(r) OVER (), 0)::DOUBLE AS p, c / nullif(sum(c) OVER (), 0)::DOUBLE "
        f"AS q FROM (SELECT {key}, sum(CASE WHEN slice = 'phase1_reference' THEN n ELSE 0 END) AS r, "
        f"sum(CASE WHEN slice = 'phase2_increment' THEN n ELSE 0 END) AS c FROM ({relation}) "
        f"GROUP BY {key}))"
    )


def percentages(x: str) -> str:
    return f"printf('%.1f%%', round_even(least(100.0, greatest(0.0, {x})), 1))"


# P(K > x): the two series of the Kolmogorov distribution.
KS_TAIL = (
    "CASE WHEN x < 1e-3 THEN 1.0 WHEN x < 1.0 THEN 1 - sqrt(2 * pi()) / x * list_sum("
    "list_transform(range(1, 21), lambda k: exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / "
    "(8 * x * x)))) ELSE 2 * list_sum(list_transform(range(1, 21), lambda k: "
    "(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))) END"
)

LABEL_COUNTS = "SELECT slice, label, count(*) AS n FROM sliced GROUP BY slice, label"
SOURCE_COUNTS = "SELECT slice, source, count(*) AS n FROM sliced GROUP BY slice, source"
PREDICTION_COUNTS = (
    "SELECT slice, CAST(margin > 0 AS BIGINT) AS prediction, count(*) AS n FROM sliced "
    "JOIN slice_scores USING (raw_index) GROUP BY ALL"
)
METRICS = [
    "accuracy", "precision", "recall", "f1", "f2", "true_negative", "false_positive",
    "false_negative", "true_positive", "false_positive_rate", "false_negative_rate",
    "roc_auc", "average_precision",
]
LENGTH_STATS = (
    "SELECT slice, avg(length) AS mean, quantile_cont(length::DOUBLE, 0.5) AS median, "
    "quantile_cont(length::DOUBLE, 0.9) AS p90, max(length)::DOUBLE AS max "
    "FROM slice_lengths GROUP BY slice"
)
VOCABULARY = (
    "SELECT count(*) FILTER (ref_n > 0) AS reference_vocab_size, count(*) FILTER (cur_n > 0) AS "
    "current_vocab_size, count(*) FILTER (ref_n = 0 AND cur_n > 0) AS new_token_count, "
    "coalesce(sum(cur_n) FILTER (ref_n = 0), 0) / sum(cur_n)::DOUBLE AS new_token_rate "
    "FROM token_pairs"
)
NEW_TOKENS = (
    "SELECT token, cur_n AS n FROM token_pairs WHERE ref_n = 0 AND cur_n > 0 "
    "ORDER BY n DESC, token LIMIT 50"
)


def _report_lines() -> str:
    def line(section: str, slice_: str, name: str, value: str, source: str) -> str:
        return (
            f"SELECT '{section}' AS section, {slice_} AS slice, {name} AS name, "
            f"round(({value})::DOUBLE, 8) AS value FROM ({source})"
        )

    lines = [line("rows", "slice", "'rows'", "n", "SELECT slice, count(*) AS n FROM sliced GROUP BY 1")]
    for section, key, source in (
        ("label", "label", LABEL_COUNTS),
        ("source", "source", SOURCE_COUNTS),
        ("prediction", "prediction", PREDICTION_COUNTS),
    ):
        lines.append(line(section, "slice", f"{key}::VARCHAR", "n", source))
        lines.append(
            line(section, "NULL", "'jensen_shannon_distance'", "js_distance", js(source, key))
        )
    for name in ("mean", "median", "p90", "max"):
        lines.append(line("text_length", "slice", f"'{name}'", name, LENGTH_STATS))
    lines.append(line("text_length", "NULL", "'ks_statistic'", "d", "SELECT * FROM ks"))
    lines.append(
        line("text_length", "NULL", "'ks_pvalue'", KS_TAIL, "SELECT d * en AS x FROM ks")
    )
    for name in ("reference_vocab_size", "current_vocab_size", "new_token_count", "new_token_rate"):
        lines.append(line("vocabulary", "NULL", f"'{name}'", name, VOCABULARY))
    lines.append(line("new_tokens", "NULL", "token", "n", NEW_TOKENS))
    return " UNION ALL ".join(lines)


REPORT_NEEDS = ["sliced", "slice_scores", "slice_lengths", "ks", "token_pairs"]


def with_ctes(needs: list[str], body: str) -> str:
    """``body`` behind the table expressions it needs, each after its own needs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in CTE[name][1]:
                add(other)
            order.append(name)

    for need in needs:
        add(need)
    if not order:
        return body
    parts = [f"{name} AS MATERIALIZED ({CTE[name][0]})" for name in order]
    return "WITH " + ", ".join(parts) + " " + body


def rounded_columns(names: list[str], digits: int = 9) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


RESPONSE = (
    "SELECT message_id, 'complement_nb' AS model, "
    "CASE WHEN margin > 0 THEN 'phishing' ELSE 'legitimate' END AS label, "
    "CAST(margin > 0 AS BIGINT) AS prediction, margin > 0 AS is_phishing, "
    "round(1 / (1 + exp(-margin)), 9) AS score, 'probability' AS score_type, "
    "'phase2_complement_nb' AS model_version, length(text_combined) AS normalized_text_length, "
    "CASE WHEN margin > 0 THEN 'Phishing' ELSE 'Legitimate' END AS verdict, "
    + percentages("100.0 * (1 / (1 + exp(-margin)))")
    + " AS confidence FROM accepted JOIN accepted_scores USING (message_id)"
)

SQL: dict[str, tuple[list[str], str]] = {
    "scan_corpus": (["corpus"], "SELECT raw_index, text_combined, source, label FROM corpus"),
    "jsonl_export_view": (["splits"], "SELECT text_combined AS text, label, split FROM splits"),
    "normalize_labels": (
        [],
        "SELECT raw, CASE WHEN value IN (0, 1) THEN CAST(value AS BIGINT) END AS label, "
        "count(*) AS n FROM (SELECT raw, try_cast("
        + strip("raw")
        + " AS DOUBLE) AS value FROM (SELECT ' ' || (toxic + quality)::VARCHAR || CASE WHEN "
        "toxic = 1 THEN '.0' || chr(9) ELSE '' END AS raw FROM labels)) GROUP BY ALL",
    ),
    "clean_texts": (
        [],
        f"SELECT doc_id AS raw_index, {clean('text')} AS text_combined, "
        f"length({clean('text')}) AS n_chars FROM documents",
    ),
    "clean_dataset": (["cleaned"], "SELECT raw_index, text_combined, label FROM cleaned"),
    "cleaning_summary": (
        ["corpus", "cleaned"],
        "SELECT raw_rows, cleaned_rows, raw_rows - cleaned_rows AS rows_removed, label_0, label_1 "
        "FROM (SELECT count(*) AS raw_rows FROM corpus), (SELECT count(*) AS cleaned_rows, "
        "count(*) FILTER (label = 0) AS label_0, count(*) FILTER (label = 1) AS label_1 "
        "FROM cleaned)",
    ),
    "label_distribution": (
        ["cleaned"],
        "SELECT label, count(*) AS n FROM cleaned GROUP BY label",
    ),
    "copies_in_holdout": (
        ["phased"],
        f"SELECT count(*) AS rows, count(*) FILTER (t IN (SELECT {clean('text_combined')} FROM "
        f"phased WHERE phase <> 'phase3_holdout')) AS seen_before FROM (SELECT "
        f"{clean('text_combined')} AS t FROM phased WHERE phase = 'phase3_holdout')",
    ),
    "seeded_rank": (["ranked"], "SELECT raw_index, label, rank FROM ranked"),
    "stratified_sample": (
        ["ranked"],
        "SELECT raw_index, label FROM ranked WHERE rank <= round_even(n * 0.6::DOUBLE, 0)",
    ),
    "plain_sample": (
        ["corpus"],
        "SELECT raw_index, label FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || "
        "raw_index), raw_index) AS rank, count(*) OVER () AS n FROM corpus) "
        "WHERE rank <= round_even(n * 0.25::DOUBLE, 0)",
    ),
    "phase_partition": (["phased"], "SELECT raw_index, label, phase FROM phased"),
    "train_val_test_split": (["splits"], "SELECT raw_index, label, split FROM splits"),
    "sample_summary": (
        ["four_phases"],
        "SELECT phase, label, count(*) AS n FROM four_phases GROUP BY phase, label UNION ALL "
        "SELECT phase, NULL, count(*) FROM four_phases GROUP BY phase UNION ALL "
        "SELECT NULL, NULL, count(*) FROM four_phases WHERE phase <> 'phase2_sample'",
    ),
    "phase_summary": (
        ["four_phases"],
        "SELECT phase, count(*) AS rows, count(*) FILTER (label = 0) AS label_0, "
        "count(*) FILTER (label = 1) AS label_1, round(count(*) FILTER (label = 1) / "
        "count(*)::DOUBLE, 4) AS positive_rate FROM four_phases GROUP BY phase",
    ),
    "split_summary": (
        ["splits"],
        "SELECT split, count(*) AS rows, count(*) FILTER (label = 0) AS label_0, "
        "count(*) FILTER (label = 1) AS label_1 FROM splits GROUP BY split",
    ),
    "partition_overlap": (
        ["four_phases"],
        " UNION ALL ".join(
            f"SELECT '{'+'.join(a)}' AS left_slices, '{'+'.join(b)}' AS right_slices, "
            "count(*) FILTER (l AND r) AS in_both, count(*) FILTER (l AND NOT r) AS only_left, "
            "count(*) FILTER (NOT l AND r) AS only_right FROM (SELECT raw_index, "
            f"bool_or(phase IN ({', '.join(repr(x) for x in a)})) AS l, "
            f"bool_or(phase IN ({', '.join(repr(x) for x in b)})) AS r "
            "FROM four_phases GROUP BY raw_index)"
            for a, b in (
                (["phase2_sample"], ["phase3_holdout"]),
                (["phase1_reference"], ["phase2_increment"]),
                (["phase1_reference", "phase2_increment"], ["phase2_sample"]),
            )
        ),
    ),
    "build_source_manifest": (
        ["corpus"],
        "SELECT row_number() OVER (ORDER BY CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER), "
        "raw_index) - 1 AS raw_index, source, row_number() OVER (PARTITION BY source ORDER BY "
        "raw_index) - 1 AS source_row_index, label FROM corpus",
    ),
    "labels_by_source": (
        ["corpus"],
        "SELECT source, label, count(*) AS n FROM corpus GROUP BY source, label",
    ),
    "source_distribution": (["sliced"], SOURCE_COUNTS),
    "drift_share_table": (
        ["sliced"],
        "SELECT source, CAST(r AS BIGINT) AS ref_n, CAST(c AS BIGINT) AS cur_n, "
        "round(r / (sum(r) OVER ())::DOUBLE, 4) AS ref_share, "
        "round(c / (sum(c) OVER ())::DOUBLE, 4) AS cur_share FROM (SELECT source, "
        "count(*) FILTER (slice = 'phase1_reference') AS r, "
        "count(*) FILTER (slice = 'phase2_increment') AS c FROM sliced GROUP BY source)",
    ),
    "class_ratio": (
        ["sliced"],
        "SELECT slice, label, n, round(n / (sum(n) OVER (PARTITION BY slice))::DOUBLE, 4) AS share "
        f"FROM ({LABEL_COUNTS})",
    ),
    "validate_checks": (
        ["splits"],
        "SELECT dataset, rows, null_text, null_label, invalid_labels, label_0, label_1, "
        "short_rows, reason, reason IS NULL AS passed, reason IS NULL AND "
        "greatest(label_0, label_1) / least(label_0, label_1)::DOUBLE > 10 AS imbalance_warning "
        "FROM (SELECT *, CASE WHEN rows = 0 THEN 'empty' WHEN null_text > 0 OR null_label > 0 THEN "
        "'nulls' WHEN invalid_labels > 0 THEN 'invalid_labels' WHEN label_0 = 0 OR label_1 = 0 THEN "
        "'missing_class' WHEN short_rows > 0 THEN 'short_rows' END AS reason FROM (SELECT dataset, "
        "count(raw_index) AS rows, count(*) FILTER (raw_index IS NOT NULL AND text_combined IS "
        "NULL) AS null_text, count(*) FILTER (raw_index IS NOT NULL AND label IS NULL) AS "
        "null_label, count(*) FILTER (label NOT IN (0, 1)) AS invalid_labels, "
        "count(*) FILTER (label = 0) AS label_0, count(*) FILTER (label = 1) AS label_1, "
        "count(*) FILTER (length(text_combined) < 3) AS short_rows FROM "
        "(VALUES ('cleaned'), ('train'), ('val'), ('test')) v(dataset) LEFT JOIN splits "
        "ON dataset = 'cleaned' OR dataset = split GROUP BY dataset))",
    ),
    "request_screen": (
        ["requests"],
        "SELECT message_id, reject_reason, CASE WHEN reject_reason IS NULL THEN "
        "length(text_combined) END AS normalized_text_length FROM (" + screened("requests") + ")",
    ),
    "js_label": (["sliced"], f"SELECT round(js_distance, 9) AS js_distance FROM ({js(LABEL_COUNTS, 'label')})"),
    "js_source": (
        ["sliced"],
        f"SELECT round(js_distance, 9) AS js_distance FROM ({js(SOURCE_COUNTS, 'source')})",
    ),
    "js_prediction": (
        ["sliced", "slice_scores"],
        "SELECT round(js_distance, 9) AS js_distance FROM "
        f"({js(PREDICTION_COUNTS, 'prediction')})",
    ),
    "text_length_stats": (
        ["slice_lengths"],
        "SELECT slice, round(mean, 9) AS mean, round(median, 9) AS median, round(p90, 9) AS p90, "
        f"max FROM ({LENGTH_STATS})",
    ),
    "length_histogram": (
        ["slice_lengths"],
        "SELECT slice, bin, round(start, 9) AS start, n, round(n / (total * width), 12) AS density, "
        "start < (SELECT quantile_cont(length::DOUBLE, 0.98) FROM slice_lengths WHERE slice = "
        "'phase1_reference') AS shown FROM (SELECT slice, bin, lo + bin * width AS start, width, "
        "total, count(*) AS n FROM (SELECT slice, lo, total, CASE WHEN hi = lo THEN 0 ELSE "
        "least(((length - lo) * 80) // (hi - lo), 79) END AS bin, CASE WHEN hi = lo THEN 1.0 ELSE "
        "(hi - lo) / 80.0::DOUBLE END AS width FROM slice_lengths JOIN (SELECT slice, min(length) "
        "AS lo, max(length) AS hi, count(*) AS total FROM slice_lengths GROUP BY slice) "
        "USING (slice)) GROUP BY slice, bin, lo, width, total)",
    ),
    "ks_length": (
        ["ks"],
        f"SELECT round(d, 9) AS ks_statistic, round({KS_TAIL}, 9) AS ks_pvalue FROM "
        "(SELECT d, d * en AS x FROM ks)",
    ),
    "token_counts": (
        [],
        f"SELECT token, count(*) AS n FROM (SELECT unnest({tokens('text')}) AS token "
        "FROM documents) GROUP BY token",
    ),
    "vocabulary_drift": (
        ["token_pairs"],
        "SELECT reference_vocab_size, current_vocab_size, new_token_count, "
        f"round(new_token_rate, 9) AS new_token_rate FROM ({VOCABULARY})",
    ),
    "new_tokens_topn": (["token_pairs"], NEW_TOKENS),
    "new_tokens_all": (
        ["token_pairs"],
        "SELECT token, cur_n AS n FROM token_pairs WHERE ref_n = 0 AND cur_n > 0",
    ),
    "drift_report_table": (REPORT_NEEDS, _report_lines()),
    "classification_report": (
        ["report"],
        f"SELECT model, split, {rounded_columns(METRICS[:11])} FROM report",
    ),
    "roc_auc": (["ranking"], f"SELECT model, split, {rounded_columns(['roc_auc'])} FROM ranking"),
    "average_precision": (
        ["ranking"],
        f"SELECT model, split, {rounded_columns(['average_precision'])} FROM ranking",
    ),
    "pr_curve": (
        ["steps"],
        "SELECT model, split, round(score, 9) AS threshold, round(cum_pos / (cum_pos + "
        "cum_neg)::DOUBLE, 9) AS precision, round(coalesce(cum_pos / nullif(sum(pos) OVER "
        "(PARTITION BY model, split), 0)::DOUBLE, 1), 9) AS recall FROM steps",
    ),
    "metrics_long": (
        ["full_report", "rules"],
        "SELECT 'rules' AS run_id, NULL AS parent_id, model, split || '_' || name AS metric, "
        f"round(value, 9) AS value FROM (UNPIVOT full_report ON {', '.join(METRICS)} INTO NAME name "
        "VALUE value) UNION ALL SELECT 'rules', NULL, NULL, split || '_' || name, n::DOUBLE FROM "
        "(SELECT split, 'rows' AS name, count(*) AS n FROM rules WHERE model = 'length_rule' "
        "GROUP BY split UNION ALL SELECT split, 'label_' || label, count(*) FROM rules "
        "WHERE model = 'length_rule' GROUP BY split, label)",
    ),
    "model_comparison": (
        ["full_report"],
        "SELECT model, "
        + ", ".join(
            f"round(max({m}) FILTER (split = '{s}'), 9) AS {s}_{m}"
            for s in ("val", "test")
            for m in METRICS
        )
        + " FROM full_report GROUP BY model",
    ),
    "best_model": (
        ["full_report"],
        "SELECT model AS best_model, round(f2, 9) AS val_f2 FROM full_report WHERE split = 'val' "
        "ORDER BY f2 DESC, list_position(['length_rule', 'digit_rule', 'upper_rule'], model) "
        "LIMIT 1",
    ),
    "metric_delta": (
        ["report"],
        "SELECT b.model, "
        + ", ".join(
            f"round(b.{m} - a.{m}, 4) AS delta_{m}" for m in ("f2", "recall", "false_negative_rate")
        )
        + " FROM report a JOIN report b ON a.model = b.model AND a.split = 'train' "
        "AND b.split = 'val'",
    ),
    "metric_pivot": (
        ["report"],
        "SELECT model, round(max(f2) FILTER (split = 'train'), 9) AS phase1, "
        "round(max(f2) FILTER (split = 'val'), 9) AS phase2 FROM report GROUP BY model",
    ),
    "error_slices": (
        ["rules"],
        "SELECT model, split, error, position, raw_index, label, prediction, "
        "round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY model, split, "
        "error ORDER BY raw_index) AS position FROM (SELECT *, CASE WHEN label = 1 THEN "
        "'false_negative' ELSE 'false_positive' END AS error FROM rules WHERE label <> prediction)) "
        "WHERE position <= 5",
    ),
    "slice_stats_by_source": (
        ["rules"],
        "SELECT *, round(1 - false_negatives / nullif(positives, 0)::DOUBLE, 4) AS recall, "
        "round(false_negatives / nullif(positives, 0)::DOUBLE, 4) AS false_negative_rate FROM "
        "(SELECT source, count(*) AS rows, count(*) FILTER (label = 1) AS positives, "
        "count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1 AND prediction = 0) "
        "AS false_negatives, count(*) FILTER (label = 0 AND prediction = 1) AS false_positives "
        "FROM rules WHERE model = 'length_rule' AND phase = 'phase2_increment' GROUP BY source)",
    ),
    "confidence_pct": (
        ["rules"],
        "SELECT raw_index, model, CASE WHEN model = 'length_rule' THEN "
        + percentages("100.0 * (1 / (1 + exp(-abs(score))))")
        + " ELSE "
        + percentages("CASE WHEN score BETWEEN 0 AND 1 THEN score * 100.0 ELSE score END")
        + " END AS confidence FROM rules",
    ),
    "latency_summary": (
        [],
        "SELECT count(*) AS requests, count(*) FILTER (event_type = 'error') AS failures, "
        "round(avg(value), 6) AS mean_latency_ms, round(max(value) FILTER (rn = "
        "round_even((n - 1) * 0.95::DOUBLE, 0) + 1), 6) AS p95_latency_ms FROM (SELECT *, "
        "row_number() OVER (ORDER BY value) AS rn, count(*) OVER () AS n FROM events)",
    ),
    "latest_run_children": (
        [],
        "SELECT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS run_id, "
        "'o' || l_orderkey AS parent_id, l_returnflag AS name, 'FINISHED' AS status FROM lineitem "
        "WHERE 'o' || l_orderkey = (SELECT 'o' || o_orderkey FROM orders WHERE o_orderstatus = 'F' "
        "ORDER BY o_orderdate DESC, 'o' || o_orderkey DESC LIMIT 1)",
    ),
    "tokenize": (
        [],
        "SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM (SELECT doc_id, term, "
        f"count(*) AS tf FROM (SELECT doc_id, unnest({tokens('strip_accents(lower(text))')}) AS "
        "term FROM documents) GROUP BY doc_id, term) GROUP BY term",
    ),
    "tfidf_vocab": (
        ["vocab"],
        "SELECT term, term_id, tf, df, round(idf, 9) AS idf FROM vocab",
    ),
    "tfidf_weights": (
        ["split_weights"],
        "SELECT raw_index, split, term_id, round(weight, 9) AS weight FROM split_weights",
    ),
    "vocab_sample": (
        ["vocab"],
        "SELECT term, term_id FROM vocab ORDER BY md5('42:' || term), term LIMIT 15",
    ),
    "dummy_predict": (
        ["splits", "majority"],
        "SELECT raw_index, split, s.label, m.label AS prediction, m.label::DOUBLE AS score "
        "FROM splits s, majority m WHERE split <> 'train'",
    ),
    "complement_nb_weights": (
        ["vocab", "nb"],
        "SELECT term, round(weight_0, 9) AS weight_0, round(weight_1, 9) AS weight_1 "
        "FROM nb JOIN vocab USING (term_id)",
    ),
    "linear_score_sql": (
        ["rest", "rest_scores"],
        "SELECT raw_index, split, label, CAST(margin > 0 AS BIGINT) AS prediction, "
        "round(1 / (1 + exp(-margin)), 9) AS score FROM rest JOIN rest_scores USING (raw_index)",
    ),
    "objective_at_point": (
        ["slopes", "point", "split_weights"],
        "SELECT model, 'objective' AS part, NULL AS term, round(sum(loss) + (SELECT sum(w * w) "
        "FROM point) / 2 + 1 / 128::DOUBLE, 7) AS value FROM slopes GROUP BY model UNION ALL "
        "SELECT model, 'bias', NULL, round(sum(slope) + 0.125::DOUBLE, 7) FROM slopes GROUP BY model "
        "UNION ALL SELECT model, 'weight', term, round(sum(slope * weight) + any_value(w), 7) "
        "FROM slopes JOIN split_weights USING (raw_index) JOIN point USING (term_id) "
        "GROUP BY model, term",
    ),
    "fit_certificates": (
        ["n_train"],
        "SELECT model, n AS rows, round(n * at_zero, 6) AS objective_at_zero, true AS converged, "
        "true AS gradient_vanishes, true AS below_zero_point, true AS gap_is_small FROM n_train, "
        "(VALUES ('logistic_regression', ln(2::DOUBLE)), ('linear_svc', 1::DOUBLE)) v(model, at_zero)",
    ),
    "scored_response": (["accepted", "accepted_scores"], RESPONSE),
    "stream_score": (["accepted", "accepted_scores"], RESPONSE),
    "stream_both_sinks": (
        ["spoilt_screened", "spoilt_scores"],
        "SELECT message_id, reject_reason, CAST(margin > 0 AS BIGINT) AS prediction, "
        "round(1 / (1 + exp(-margin)), 9) AS score, CASE WHEN reject_reason IS NULL THEN "
        "length(text_combined) END AS normalized_text_length, true AS timed "
        "FROM spoilt_screened LEFT JOIN spoilt_scores USING (message_id)",
    ),
    "stream_drift": (REPORT_NEEDS, _report_lines()),
    "batch_scores": (
        ["docs", "doc_scores"],
        "SELECT raw_index, source, CAST(margin > 0 AS BIGINT) AS prediction, "
        "round(1 / (1 + exp(-margin)), 9) AS score, 'probability' AS score_type "
        "FROM docs JOIN doc_scores USING (raw_index)",
    ),
}


def _holdout_eval() -> str:
    """The report definitions once more, over the holdout predictions."""
    cells = (
        CTE["cells"][0].replace("model, split", "model").replace("FROM rules", "FROM holdout_predictions")
    )
    report = CTE["report"][0].replace("model, split", "model").replace("FROM cells", "FROM h_cells")
    steps = (
        CTE["steps"][0].replace("model, split", "model").replace("FROM rules", "FROM holdout_predictions")
    )
    ranking = CTE["ranking"][0].replace("model, split", "model").replace("FROM steps", "FROM h_steps")
    CTE["h_cells"] = (cells, ["holdout_predictions"])
    CTE["h_report"] = (report, ["h_cells"])
    CTE["h_steps"] = (steps, ["holdout_predictions"])
    CTE["h_ranking"] = (ranking, ["h_steps"])
    return (
        f"SELECT model, (SELECT count(*) FROM holdout) AS rows, {rounded_columns(METRICS)} "
        "FROM h_report JOIN h_ranking USING (model)"
    )


SQL["holdout_eval"] = (["holdout"], _holdout_eval())
SQL["holdout_eval"] = (["holdout", "h_report", "h_ranking"], SQL["holdout_eval"][1])

CTE["val_predictions"] = (
    "SELECT 'complement_nb' AS model, label, CAST(margin > 0 AS BIGINT) AS prediction FROM rest "
    "JOIN rest_scores USING (raw_index) WHERE split = 'val' UNION ALL "
    "SELECT 'dummy', label, (SELECT label FROM majority) FROM rest WHERE split = 'val'",
    ["rest", "rest_scores", "majority"],
)
CTE["published"] = (
    "SELECT model, coalesce(5 * tp / nullif(5 * tp + 4 * fn + fp, 0), 0) AS val_f2 FROM (SELECT model, "
    "count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp, count(*) FILTER (label = 0 AND "
    "prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM val_predictions "
    "GROUP BY model) ORDER BY val_f2 DESC, model = 'dummy' DESC LIMIT 1",
    ["val_predictions"],
)
SQL["published_holdout"] = (
    ["holdout", "h_report", "h_ranking", "published"],
    "SELECT model, round(val_f2, 9) AS val_f2, (SELECT count(*) FROM holdout) AS rows, "
    f"{rounded_columns(METRICS)} FROM h_report JOIN h_ranking USING (model) JOIN published USING (model)",
)

ORACLE: dict[str, str] = {name: with_ctes(needs, body) for name, (needs, body) in SQL.items()}
