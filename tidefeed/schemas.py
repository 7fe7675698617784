"""Record layouts of the three feeds, and of the tagged union that carries them.

The field names and types below are fixed values: they must equal the feeds' own.
"""

from pyspark.sql import types as T

_INT, _TEXT = T.IntegerType(), T.StringType()


def _layout(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


OMS = _layout(
    num_obitos=_INT,
    populacao=_INT,
    cep=_INT,
    num_recuperados=_INT,
    num_vacinados=_INT,
    data=_TEXT,
)

HOSPITAL = _layout(
    id_hospital=_INT,
    data=_TEXT,
    internado=_INT,
    idade=_INT,
    sexo=_INT,
    cep=_INT,
    sintoma1=_INT,
    sintoma2=_INT,
    sintoma3=_INT,
    sintoma4=_INT,
)

SECRETARIA = _layout(
    diagnostico=_INT,
    vacinado=_INT,
    cep=_INT,
    escolaridade=_INT,
    populacao=_INT,
    data=_TEXT,
)

FEEDS = {"oms": OMS, "hospital": HOSPITAL, "secretaria": SECRETARIA}

#: One record of a drop: exactly one of the three structs is set.
TAGGED_UNION = _layout(
    origem=_TEXT,
    nome_arquivo=_TEXT,
    **{f"linha_{feed}": layout for feed, layout in FEEDS.items()},
)
