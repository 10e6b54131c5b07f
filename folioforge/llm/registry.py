"""All queries of this subpackage and their SQL."""

from . import q_ann, q_bpe, q_htmltext, q_mixing, q_pii, q_quality, q_sharding, q_simhash, q_simhash_dedup, q_tokenfile

MODULES = (q_ann, q_bpe, q_htmltext, q_mixing, q_pii, q_quality, q_sharding, q_simhash, q_simhash_dedup, q_tokenfile)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
