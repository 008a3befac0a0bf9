"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from seawake import session
from seawake.llm import (
    alignment, byte_bpe, decontaminate, jaccard_join, language, line_dedup, mixture, quality, secrets, token_counts,
    token_files, toxicity, whitening)
from seawake.llm.common import table

WORD_TOKENIZER, PIECE_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"

MIX = mixture.Mix(
    domains={"0": "web", "1": "web", "2": "web", "3": "web", "4": "web", "5": "books", "6": "books", "7": "books",
             "8": "papers", "9": "papers"},
    weights={"domain": {"web": 5, "books": 3, "papers": 4}, "lang": {"en": 6, "de": 3, "fr": 2, "es": 2},
             "source": {"src0": 4, "src5": 2, "src8": 3}})


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixture(spark, sf_dir):
    return mixture.mixture(table(spark, sf_dir, "documents"), MIX)


def op2_quality(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(PIECE_TOKENIZER))


def op6_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    folder = session.shared_dir(spark, "token_files")
    token_files.write_token_files(docs, folder, tokenizer(WORD_TOKENIZER))
    return token_files.read_token_files(spark, folder)


def op7_secrets(spark, sf_dir):
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.with_digests(found)


def op9_line_dedup(spark, sf_dir):
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark, sf_dir):
    found = alignment.aligned(table(spark, sf_dir, "documents"), tokenizer(BYTE_TOKENIZER), tokenizer(PIECE_TOKENIZER))
    return alignment.with_counts(alignment.digests(found))


def op12_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks, pattern = tokenizer(BYTE_RANKS), public_tokenizers.PATTERN
    ids = byte_bpe.encoded(table(spark, sf_dir, "documents"), ranks, pattern)
    return byte_bpe.digests(byte_bpe.decoded(ids, ranks, pattern))


def op13_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_mixture, op2_quality, op3_language, op4_jaccard_join, op5_token_counts, op6_token_files, op7_secrets, op8_decontaminate,
    op9_line_dedup, op10_toxicity, op11_alignment, op12_byte_bpe, op13_whitening)}


def _levels() -> str:
    out = ""
    for k, (path, up) in enumerate((("domain", None), ("domain, lang", "domain"), ("domain, lang, source", "domain, lang"))):
        name = path.split(", ")[-1]
        cases = " ".join(f"WHEN '{n}' THEN {w}" for n, w in MIX.weights[name].items())
        budget = (f"least(floor(sum(sum(tokens)) OVER () * {MIX.budget_percent} / 100)::HUGEINT, sum(sum(capacity)) OVER ())"
                  if up is None else "any_value(p.budget)")
        join = f"JOIN n{k - 1} p USING ({up})" if up else ""
        over = f"PARTITION BY {up}" if up else ""
        order = f"{over} ORDER BY capacity::DOUBLE / weight::DOUBLE, {name}"
        out += f"""
l{k} AS (SELECT {path}, sum(capacity)::HUGEINT AS capacity, (CASE {name} {cases} ELSE {MIX.default} END)::HUGEINT AS weight,
  ({budget})::HUGEINT AS budget FROM leaves {join} GROUP BY {path}),
f{k} AS (SELECT *, capacity * (sum(weight) OVER ({over}) - coalesce(sum(weight) OVER (
    {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) <= (budget - coalesce(sum(capacity) OVER (
    {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full FROM l{k} WHERE capacity > 0),
g{k} AS (SELECT *, (budget - coalesce(sum(capacity) FILTER (WHERE is_full) OVER ({over}), 0))::HUGEINT AS rest,
  (CASE WHEN is_full THEN 0 ELSE weight END)::HUGEINT AS own,
  coalesce(sum(weight) FILTER (WHERE NOT is_full) OVER ({over}), 0)::HUGEINT AS whole_weight,
  sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::HUGEINT AS upto
  FROM f{k}),
n{k} AS (SELECT {path}, CASE WHEN is_full THEN capacity
  ELSE rest * upto // whole_weight - rest * (upto - own) // whole_weight END AS budget FROM g{k}),"""
    return out


_DOMAIN = " ".join(f"WHEN '{d}' THEN '{n}'" for d, n in MIX.domains.items())
ORACLE = {
    "op1_mixture": rf"""
WITH t AS (SELECT doc_id, CASE regexp_extract(coalesce(source, '(none)'), '([0-9])$', 1) {_DOMAIN} ELSE 'other' END AS domain,
  coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {MIX.epochs} AS capacity
  FROM t WHERE n_tokens > 0 GROUP BY ALL),{_levels()}
b AS (SELECT l.*, (n.budget // l.tokens)::BIGINT AS whole, (n.budget % l.tokens)::BIGINT AS rest
  FROM leaves l JOIN n2 n USING (domain, lang, source) WHERE n.budget > 0),
o AS (SELECT t.*, whole, rest, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws(':', '{MIX.seed}', (whole + 1)::VARCHAR, coalesce(doc_id::VARCHAR, '(none)'))), doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier
  FROM t JOIN b USING (domain, lang, source) WHERE n_tokens > 0)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, whole + 1))::INTEGER AS epoch, n_tokens AS taken FROM o
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, (whole + 1)::INTEGER, least(n_tokens, rest - earlier) FROM o WHERE rest > earlier
""",
    "op9_line_dedup": line_dedup.ORACLE,
}
