"""Queries of the problems on text corpora and record fusion: 5, 8, 9 and 10."""

from __future__ import annotations

from ..session import table
from . import fusion, leaks, mixing, truncation

QUERIES = {
    "p5_found": lambda s, d: fusion.p5_found(table(s, d, "fact_lab_raw"), table(s, d, "source_sites")),
    "p5_fused": lambda s, d: fusion.fuse(table(s, d, "fact_lab_raw"), table(s, d, "source_sites")),
    "p5_source_accuracy": lambda s, d: fusion.source_accuracy(table(s, d, "fact_lab_raw"), table(s, d, "source_sites")),
    "p8_found": lambda s, d: leaks.p8_found(table(s, d, "documents"), table(s, d, "eval_items")),
    "p8_leaked_items": lambda s, d: leaks.leaked_items(table(s, d, "documents"), table(s, d, "eval_items")),
    "p9_found": lambda s, d: mixing.p9_found(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p9_shares": lambda s, d: mixing.shares(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p9_mix": lambda s, d: mixing.mix(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p10_found": lambda s, d: truncation.p10_found(table(s, d, "documents")),
    "p10_rates": lambda s, d: truncation.rates(table(s, d, "documents")),
    "p10_limits": lambda s, d: truncation.hidden_limits(table(s, d, "documents")),
}
STAND_INS = ", ".join(f"'{x}'" for x in ("", *fusion.STAND_INS))

LEAKS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
r AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 14], ' ') AS run, w[k] AS first FROM i, range(1, len(w) - 13) t(k)), p AS (SELECT doc_id, array_to_string(w[k:k + 14], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM d) WHERE w[k] IN (SELECT first FROM r)),
f AS (SELECT DISTINCT doc_id, item_id FROM p JOIN r USING (run)) """

SQL: dict[str, str] = {
    "p8_found": LEAKS + "SELECT doc_id, item_id FROM f",
    "p8_leaked_items": LEAKS + "SELECT item_id, item_set, count(doc_id) AS n_documents FROM eval_items LEFT JOIN f USING (item_id) GROUP BY ALL",
    "p5_found": f"""WITH r AS (SELECT lower(trim(key_hash)) AS k, row_id, coalesce(trust_rank, 2147483647) AS trust, incr_counter, received_dtm, result_txt, unit_of_measure_txt, normal_range_txt, specimen_txt FROM fact_lab_raw LEFT JOIN source_sites USING (site_code) WHERE trim(key_hash) <> ''),
m AS (SELECT k FROM r GROUP BY 1 HAVING count(*) >= 2), u AS (UNPIVOT r ON {", ".join(fusion.FIELDS)} INTO NAME field_name VALUE v)
SELECT k AS key_hash, field_name, row_id FROM u SEMI JOIN m USING (k) WHERE lower(trim(v)) NOT IN ({STAND_INS}) QUALIFY row_number() OVER (PARTITION BY k, field_name ORDER BY trust, incr_counter DESC, received_dtm DESC, row_id DESC) = 1""",
}
