"""Tokens, thresholds and names that results must reproduce literally."""

# Parts of the local day, with the hour each one ends at (exclusive).
DAY_PARTS = (("madrugada", 6), ("manana", 12), ("tarde", 19), ("noche", 24))

# Time since the previous impression, with the inclusive upper bound in seconds.
GAP_FIRST = "primera"
GAP_BUCKETS = (("0-5min", 300), ("5-60min", 3600), ("1-24h", 86400))
GAP_LAST = "mas_1d"

# What stands for "unknown".
SENTINEL = -1
UNKNOWN_TOKEN = "DESCONOCIDO"

# Imputation decisions.
NO_ACTION = "sin_accion"
DROP_ROWS = "descartar_fila"
IMPUTE_MODE = "imputar_moda"
KEEP_UNKNOWN = "categoria_desconocido"

# Verdicts of the checks.
OK = "OK"
DUPLICATES = "DUPLICA"
LOSES_ROWS = "PIERDE FILAS"
KEY_NOT_UNIQUE = "CLAVE NO ÚNICA"
LEAK = "FUGA"
BURN_IN_TOO_SHORT = "BURN-IN INSUFICIENTE"
IMPOSSIBLE_VALUE = "VALOR IMPOSIBLE"

# Verdicts of this library's own.
NO_SPREAD = "NO SPREAD"
NO_ROWS = "NO ROWS"

# The published models: kind, settings, grid (first value of a row varies slowest),
# whether vectors are scaled, and whether features learnt from past clicks are used.
MODELS = {
    "lr_context": ("logistic", {"maxIter": 50}, {"regParam": (0.0, 0.01), "elasticNetParam": (0.0,)},
                   True, False),
    "lr_full": ("logistic", {"maxIter": 50},
                {"regParam": (0.0, 0.001, 0.01), "elasticNetParam": (0.0, 0.5)}, True, True),
    "rf_full": ("forest", {"numTrees": 60, "maxDepth": 8, "subsamplingRate": 0.7},
                {"maxDepth": (6, 10), "numTrees": (60,)}, False, True),
    "gbt_full": ("boosting", {"maxIter": 40, "maxDepth": 5, "stepSize": 0.1},
                 {"maxDepth": (4, 6), "maxIter": (40,)}, False, True),
}

# Split labels.
SPLIT_BURN_IN = "burn-in (no se entrena)"
SPLIT_TRAIN = "train"
SPLIT_VAL = "val"
SPLIT_TEST = "test"
SPLIT_OUTSIDE = "fuera de rango"

# Published column name of every column whose name differs here.
PUBLISHED_NAMES = {
    "d": "fecha_local",
    "ts_utc_s": "ts_utc",
    "hour": "hora_local",
    "day_part": "franja",
    "dow": "dia_semana",
    "weekend": "es_finde",
    "no_profile": "sin_perfil",
    "brand_known": "brand_conocida",
    "price_valid": "precio_valido",
    "gap_bucket": "bucket_gap",
    "ctr_user_prev": "ctr_usuario_previo",
    "log_imp_prev": "log_imp_previas_usuario",
    "order_capped": "orden_impresion",
    "log_gap": "log_gap_seg",
    "ctr_6h": "ctr_movil_6h_slot",
    "price_rel": "precio_rel_categoria",
    "p_calibrated": "p_calibrada",
}
