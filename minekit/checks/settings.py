"""Parameters that the registered queries and their SQL share."""

from __future__ import annotations

from minekit.operators.minhash import MinHash
from minekit.plans.similar import SimilarDocuments

RANK_STEPS = 20
BETA = 0.8
KMEANS_STEPS = 20
SEARCH = SimilarDocuments(k=3, family=MinHash(100, seed=0), bands=50, rows=2, id_method="md5")
TOP = 10
CORPUS_FOLDERS = 256
MIN_LEAF = 25
CANDIDATES = 10
# how many levels the SQL twin unrolls; the tree itself ends when no node is open
SQL_LEVELS = 16
TRAIN_SHARE = 0.9
SEED = 0
