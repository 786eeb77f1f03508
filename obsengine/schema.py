"""Names and types shared by all layers.

Timestamps are TIMESTAMP_NTZ throughout: measurements carry station-local wall
clock hours and no zone, so the results must not depend on the session zone.
"""

from pyspark.sql import types as T

SERIES = ["cod_ubic", "cod_conf", "sigla_param"]
LEVEL = "cod_liv_validazione"

# The grain of a prepared measurement; see operators.quality.
MEASUREMENT_KEY = SERIES + ["data_da", "data_a"]

PREP_SCHEMA = T.StructType(
    [
        T.StructField("cod_ubic", T.StringType()),
        T.StructField("cod_conf", T.IntegerType()),
        T.StructField("cod_param", T.StringType()),
        T.StructField("data_da", T.TimestampNTZType()),
        T.StructField("data_a", T.TimestampNTZType()),
        T.StructField("val_param", T.DoubleType()),
        T.StructField("cod_valid", T.IntegerType()),
        T.StructField("cod_validaz", T.StringType()),
        T.StructField("cod_validaz_reg", T.StringType()),
        T.StructField("anno", T.IntegerType()),
        T.StructField("cod_freq", T.StringType()),
        T.StructField("sigla_param", T.StringType()),
    ]
)

_VALUE_FIELDS = [
    ("dati_teorici", T.IntegerType()),
    ("valori_rilevati", T.LongType()),
    ("percentuale_validita", T.DoubleType()),
    ("validita_indicatore", T.StringType()),
]

_SERIES_FIELDS = [
    ("cod_ubic", T.StringType()),
    ("cod_conf", T.IntegerType()),
    ("sigla_param", T.StringType()),
    ("livello_validazione", T.StringType()),
    (LEVEL, T.StringType()),
    ("nome_indicatore", T.StringType()),
]

DAILY_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("data", T.DateType()),
            *_SERIES_FIELDS,
            ("riferimento_normativo", T.StringType()),
            ("condizione_sul_limite", T.StringType()),
            ("valore", T.DoubleType()),
            ("note_di_lavoro", T.StringType()),
            *_VALUE_FIELDS,
        ]
    ]
)

ANNUAL_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("anno", T.IntegerType()),
            *_SERIES_FIELDS,
            ("valore_limite", T.StringType()),
            ("condizione_sul_limite", T.StringType()),
            ("livello_critico", T.StringType()),
            ("valore", T.DoubleType()),
            *_VALUE_FIELDS,
        ]
    ]
)
