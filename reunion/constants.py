"""Fixed values of the linkage model.

Everything a result depends on numerically lives here, so that the Spark
pipeline and the SQL cross-checks use the very same doubles.
"""

from __future__ import annotations

# --- fixed values (must stay as they are for results to agree) -------------

# Link threshold used when the caller gives none.
DEFAULT_THRESHOLD = 0.5

# Prior probability that two random records are the same entity (untrained model).
DEFAULT_PRIOR = 0.1

# Lower-cased column names that get the Jaro-Winkler name comparison.
NAME_LIKE_COLUMNS = frozenset({"name", "first_name", "last_name", "surname", "forename", "full_name"})

# Jaro-Winkler bands of the name comparison, best first (exact match sits above them).
NAME_JW_THRESHOLDS = (0.92, 0.88, 0.7)

# Edit-distance bands of the general comparison, best first (exact match sits above them).
EDIT_DISTANCE_THRESHOLDS = (1, 2)

# Digits Jaro-Winkler is rounded to before it is compared with a band.
JW_ROUND_DIGITS = 12

# Jaro-Winkler: prefix bonus only above this Jaro value, prefix scale and cap.
JW_BOOST_THRESHOLD = 0.7
JW_PREFIX_SCALE = 0.1
JW_PREFIX_MAX = 4

# Default m/u rule for a comparison with n levels (worst first):
#   m = [0.05/(n-1)] * (n-1) + [0.95]
#   log2 weights: n-1 values evenly spaced from -5 to 3, then 10
#   u = m / 2**weight, then u divided by its sum
DEFAULT_M_NON_EXACT_TOTAL = 0.05
DEFAULT_M_EXACT = 0.95
DEFAULT_WEIGHT_LOW = -5.0
DEFAULT_WEIGHT_HIGH = 3.0
DEFAULT_WEIGHT_EXACT = 10.0

# Training.
TRAIN_PRIOR_RECALL = 0.7
TRAIN_U_MAX_PAIRS = 1_000_000
TRAIN_U_SEED = 1
EM_MAX_ITERATIONS = 25
EM_TOLERANCE = 1e-4
PROBABILITY_FLOOR = 1e-12

# Rounding of probabilities in published query results (both engines).
RESULT_ROUND_DIGITS = 9

# Output columns and their comments.
CLUSTER_COL = "cluster_id"
PROB_COL = "match_probability"
RESERVED_COLUMNS = (CLUSTER_COL, PROB_COL)
CLUSTER_COMMENT = "Entity number: equal for all rows that were resolved to one entity."
PROB_COMMENT = "Probability of the best link that joins the row to its entity; 1.0 if it stands alone."

# --- end of fixed values ----------------------------------------------------

# Level number given to a pair when either side is NULL: neutral, factor 1.
NULL_LEVEL = -1


def default_m_u(n_levels: int) -> tuple[list[float], list[float]]:
    """Default (m, u) lists, worst level first, for a comparison with ``n_levels`` levels."""
    if n_levels < 2:
        raise ValueError("a comparison needs at least two levels")
    k = n_levels - 1
    m = [DEFAULT_M_NON_EXACT_TOTAL / k] * k + [DEFAULT_M_EXACT]
    if k == 1:
        weights = [DEFAULT_WEIGHT_LOW]
    else:
        step = (DEFAULT_WEIGHT_HIGH - DEFAULT_WEIGHT_LOW) / (k - 1)
        weights = [DEFAULT_WEIGHT_LOW + i * step for i in range(k)]
    weights.append(DEFAULT_WEIGHT_EXACT)
    u_raw = [mi / 2.0**wi for mi, wi in zip(m, weights)]
    total = sum(u_raw)
    return m, [x / total for x in u_raw]
