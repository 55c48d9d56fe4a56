"""Fixed values and defaults.

The values under "fixed values" must stay as they are for results to agree
with the reference behaviour; the defaults are ordinary parameters.
"""

# ---- fixed values (reference behaviour) -------------------------------------
# Document line format: <doc id="ID" url="URL" title="TITLE">BODY</doc>
ID_OPEN = 'id="'
ID_CLOSE = '" url='
BODY_OPEN = '">'
BODY_TAIL_CHARS = 6  # characters cut from the end of every line ("</doc>")
DOC_CLOSE = "</doc>"
# A word is a maximal run of ASCII letters, lower-cased after extraction.
WORD_PATTERN = "[a-zA-Z]+"
NON_WORD_PATTERN = "[^a-zA-Z]+"
# Label 1 iff the document id starts with this prefix.
REFERENCE_LABEL_PREFIX = "AU"
# Gradient descent stops when the L2 norm of the weight change is <= this.
GD_TOLERANCE = 0.1
# Number of strongest words reported after gradient descent.
TOP_WORDS = 5
# At most this many false positives are reported with their text.
FALSE_POSITIVE_LIMIT = 3
# Spark ML estimators run with maxIter=100 and all other defaults.
ML_MAX_ITER = 100

# ---- defaults -----------------------------------------------------------------
DICTIONARY_SIZE = 20000
SELECTED_FEATURES = 10000
# The ordering key of the variance selection keeps this many decimals of its
# scientific notation, so that sums computed in a different order (another
# engine, another partitioning) rank alike whatever their magnitude.
VARIANCE_KEY_DECIMALS = 9
# Largest lookup table (dictionary, selection) shipped to every task with
# broadcast(), by its measured size.
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
# Text that one task tokenises and counts by document.
TASK_TEXT_BYTES = 8 * 1024 * 1024
