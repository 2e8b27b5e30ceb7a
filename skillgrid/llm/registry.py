"""All queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from . import ann, bpe, centroids, dedup, jaccard, langid, licences, mixing, phrases, pii, secrets, topk, toxicity

_MODULES = (bpe, topk, ann, licences, jaccard, langid, secrets, toxicity, pii, mixing, centroids, phrases, dedup)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in m.ORACLE.items()}
