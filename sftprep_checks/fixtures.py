"""Parameters shared by the Spark queries and their SQL oracles."""

CHUNK_SIZE = 1024  # the generation defaults
CHUNK_OVERLAP = 200
GENERATE_NUM = 2
MD_CHUNK_SIZE = 1000  # the markdown chunker's own defaults
MD_OVERLAP = 100
SHARDS = 7
CALIBRATION_N = 15
CALIBRATION_SEED = 42
CALIBRATION_MAX_TOKENS = 64
EXTENSION_K = 3
EXTENSION_SEED = 3407
