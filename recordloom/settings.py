"""Names and defaults shared by every operator."""

# Column names, separators and thresholds that results depend on.
HASH_DIFF = "hdiff"
LOAD_TS = "ldts"
CLUSTER_ID = "cluster_id"
COMPOSITE_ID = "composite_id"
DATA_SOURCE = "data_source"
UNIQUE_ID = "unique_id"
KEY_SEPARATOR = "-__-"
ORPHAN_PREFIX = "orphan_"
UNKNOWN_PARTITION = "UNKNOWN"
PREDICT_THRESHOLD = 0.01
CLUSTER_THRESHOLD = 0.9
DETERMINISTIC_RECALL = 0.7
MAX_RANDOM_PAIRS = 10_000_000
SAMPLE_ROWS = 1000
FUZZY_THRESHOLD = 80
MIN_LOCATION_LENGTH = 3
