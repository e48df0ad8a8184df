"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


S, L, D = T.StringType(), T.LongType(), T.DoubleType()

CELLS = _schema(file_id=S, sheet_idx=L, sheet_name=S, row_idx=L, col_idx=L, value=S, value_type=S)
SHEETS = _schema(file_id=S, sheet_idx=L, sheet_name=S, max_row=L, max_col=L)
HEADER_DICT = _schema(raw=S, standard=S, line_no=L)
VALUE_DICT = _schema(field=S, raw=S, standard=S, line_no=L)

DIMENSION = _schema(
    id_chronogramme=L,
    nom_chronogramme=S,
    date_exercice=S,
    lieu_exercice=S,
    etablissement_nom=S,
    etablissement_type=S,
    submitter=S,
    date_soumission=S,
    fichier_source=S,
    nb_injects=L,
)

FACT = _schema(
    id_inject_global=L,
    id_chronogramme=L,
    id_inject=S,
    horodatage=S,
    description=S,
    emetteur=S,
    destinataire=S,
    type_inject=S,
    modalite=S,
    phase_exercice=S,
    observations=S,
    etablissement_nom=S,
    etablissement_type=S,
)

MAPPING_LOG = _schema(
    id_chronogramme=L, scope=S, nom_original=S, champ_standard=S, original_norm=S,
    standard_norm=S, methode=S, horodatage=S,
)

SUBMISSION = _schema(
    file_path=S,
    nom_chronogramme=S,
    date_exercice=S,
    lieu_exercice=S,
    etablissement_nom=S,
    etablissement_type=S,
    submitter=S,
    nom_fichier_excel=S,
    nb_injects=S,
)

RUN_STEP = _schema(name=S, duration=D, chrono_id=S, rows=L, inserted=L, error=S)
RUN_RECORD = T.StructType(
    [
        T.StructField("event", S),
        T.StructField("step", S),
        T.StructField("status", S),
        T.StructField("duration", D),
        T.StructField("total_duration", D),
        T.StructField("error", S),
        T.StructField("steps", T.ArrayType(RUN_STEP)),
        T.StructField("corrupt", S),
    ]
)

# Fields of the target table, required ones, closed lists.
FIELDS = [
    "id_inject",
    "horodatage",
    "description",
    "emetteur",
    "destinataire",
    "type_inject",
    "modalite",
    "phase_exercice",
    "observations",
    "etablissement_nom",
    "etablissement_type",
]
REQUIRED_FIELDS = ["id_inject", "type_inject"]
ALLOWED = {"type_inject": ["Critique", "Important", "Secondaire"]}

# Method names in the mapping log.
METHOD_DICT, METHOD_OK, METHOD_RULE, METHOD_RESOLVER = "dict", "ok", "règle", "IA"


@dataclass(frozen=True)
class TargetSchema:
    """Field list of the target table; a driver-side constant that fixes the pivot list."""

    fields: list[str] = field(default_factory=lambda: list(FIELDS))
    required: list[str] = field(default_factory=lambda: list(REQUIRED_FIELDS))
    allowed: dict[str, list[str]] = field(default_factory=lambda: dict(ALLOWED))

# Cell texts that count as empty when a table's data rows are read.
NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
