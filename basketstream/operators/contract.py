"""Closed-world contract checks on JSON text.

A record is parsed once to VARIANT. Each rule looks at type and value of one
path; key sets are compared per object, so unknown keys are found at every level.
The result is the array of broken rule codes, empty for a valid record.

Nearly all records have exactly the declared keys and types. One look at the
record's own schema tells, and then only the values are left to check; the rules
that inspect types path by path run for the other records only.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketstream import fixed_values as fixed
from basketstream.functions.checks import all_failures, any_failure, failing_codes, no_codes
from basketstream.functions.ids import is_uuid
from basketstream.functions.once import add_once
from basketstream.sources.tables import table_of

_DATE_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?"
    r"([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$"
)
# The pattern as the contract's own dialect reads it: only a line feed ends a line.
_VECTOR = r"^\[[^\n]*\]\n?\z"


class _AnyRecord:
    """Paths of a VARIANT column about which nothing is known."""

    def __init__(self, root: Column):
        self.root = root

    def _path(self, path):
        return f"$.{path}" if path else "$"

    def type_of(self, path) -> Column:
        return F.schema_of_variant(F.try_variant_get(self.root, self._path(path), "variant"))

    def text(self, path) -> Column:
        """The value if it is a JSON string, else null."""
        value = F.try_variant_get(self.root, self._path(path), "string")
        return F.when(self.type_of(path) == "STRING", value)

    def whole(self, path) -> Column:
        """The value if it is an integer (1.0 counts as one), else null."""
        integral = self.type_of(path).rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\))$")
        return F.when(integral, F.try_variant_get(self.root, self._path(path), "decimal(38,0)"))

    def keys(self, path) -> Column:
        """Sorted keys of an object, null for anything else."""
        members = F.try_variant_get(self.root, self._path(path), "map<string,variant>")
        return F.array_sort(F.map_keys(members))

    def judge(self, rules) -> Column:
        """Broken rule codes; text that is no JSON object has just one."""
        no_object = F.array(F.lit("not_an_object"))
        return F.when(self.keys("").isNull(), no_object).otherwise(failing_codes(rules))

    # Failing conditions. Each is never null.

    def not_object(self, path, keys) -> Column:
        """Not an object with exactly these keys."""
        return ~F.coalesce(self.keys(path) == F.array(*[F.lit(key) for key in sorted(keys)]), F.lit(False))

    def not_text(self, path, accepted) -> Column:
        return ~F.coalesce(accepted(self.text(path)), F.lit(False))

    def not_whole(self, path, high=None) -> Column:
        value = self.whole(path)
        accepted = value >= 0 if high is None else (value >= 0) & (value <= high)
        return ~F.coalesce(accepted, F.lit(False))

    def not_null_value(self, path) -> Column:
        return ~F.coalesce(self.type_of(path) == "VOID", F.lit(False))


class _ShapedRecord:
    """Fields of a record known to have the declared keys and types.

    Only the keys of an event's payload depend on the event and stay to be checked.
    """

    def __init__(self, doc: Column, codes=failing_codes):
        self.doc, self.codes = doc, codes

    def text(self, path) -> Column:
        value = self.doc
        for name in path.split("."):
            value = value[name]
        return value

    whole = text

    def keys(self, path) -> Column:
        return F.array()

    def judge(self, rules) -> Column:
        return self.codes([(code, failing) for code, failing in rules if failing is not None])

    def not_object(self, path, keys):
        return self.text(f"{path}.{keys[0]}").isNull() if path == "payload" else None

    def not_text(self, path, accepted) -> Column:
        return ~F.coalesce(accepted(self.text(path)), F.lit(False))

    def not_whole(self, path, high=None) -> Column:
        value = self.whole(path)
        return ~F.coalesce(value.between(0, high) if high is not None else value >= 0, F.lit(False))

    def not_null_value(self, path):
        return None


def _equals(text):
    return lambda value: value == text


def _one_of(texts):
    return lambda value: value.isin(list(texts))


def _non_empty(value):
    return F.length(value) > 0


def _date_time(value):
    day = F.try_to_timestamp(F.substring(value, 1, 10), F.lit("yyyy-MM-dd"))
    return value.rlike(_DATE_TIME) & day.isNotNull()


def _source_rules(record, files):
    return [
        ("source_keys", record.not_object("source", ["dataset", "file", "row_number"])),
        ("source_dataset", record.not_text("source.dataset", _equals(fixed.DATASET))),
        ("source_file", record.not_text("source.file", lambda value: _one_of(files)(table_of(value)))),
        ("source_row_number", record.not_whole("source.row_number")),
    ]


def _replay_rules(record, instant):
    return [
        ("replay_keys", record.not_object("replay", ["run_id", instant])),
        ("replay_run_id", record.not_text("replay.run_id", is_uuid)),
        (f"replay_{instant}", record.not_text(f"replay.{instant}", _date_time)),
    ]


def _event_errors(record) -> Column:
    kind = record.text("event_type")
    product = kind.isin(fixed.SKU_EVENT_TYPES) & (
        record.not_object("payload", ["sku"]) | record.not_whole("payload.sku")
    )
    page = (kind == "page_visit") & (
        record.not_object("payload", ["url_id"]) | record.not_whole("payload.url_id")
    )
    search = (kind == "search_query") & (
        record.not_object("payload", ["query_vector_raw"])
        | record.not_text("payload.query_vector_raw", lambda value: value.rlike(_VECTOR))
    )
    top = [
        "schema_version", "event_id", "event_type", "event_time", "event_time_timezone",
        "client_id", "payload", "source", "replay",
    ]
    return record.judge([
        ("keys", record.not_object("", top)),
        ("schema_version", record.not_text("schema_version", _equals(fixed.SCHEMA_VERSION))),
        ("event_id", record.not_text("event_id", is_uuid)),
        ("event_type", record.not_text("event_type", _one_of(fixed.EVENT_TYPES))),
        ("event_time", record.not_text("event_time", lambda value: value.rlike(fixed.SOURCE_TIME_PATTERN))),
        ("event_time_timezone", record.not_null_value("event_time_timezone")),
        ("client_id", record.not_whole("client_id")),
        ("payload", product | page | search),
        *_source_rules(record, fixed.EVENT_FILES.values()),
        *_replay_rules(record, "published_at"),
    ])


def _product_errors(record) -> Column:
    top = [
        "schema_version", "record_id", "sku", "category_id", "price_bucket",
        "name_vector_raw", "source", "replay",
    ]
    return record.judge([
        ("keys", record.not_object("", top)),
        ("schema_version", record.not_text("schema_version", _equals(fixed.SCHEMA_VERSION))),
        ("record_id", record.not_text("record_id", is_uuid)),
        ("sku", record.not_whole("sku")),
        ("category_id", record.not_whole("category_id")),
        ("price_bucket", record.not_whole("price_bucket", fixed.MAX_PRICE_BUCKET)),
        ("name_vector_raw", record.not_text("name_vector_raw", lambda value: value.rlike(_VECTOR))),
        *_source_rules(record, [fixed.PRODUCT_FILE]),
        *_replay_rules(record, "published_at"),
    ])


_DLQ_KEYS = ["schema_version", "dlq_id", "original_topic", "source", "replay", "error", "raw_record"]


def _dlq_errors(record) -> Column:
    stages = [fixed.STAGE_TRANSFORMATION, fixed.STAGE_CONTRACT]
    return record.judge([
        ("keys", record.not_object("", _DLQ_KEYS)),
        ("schema_version", record.not_text("schema_version", _equals(fixed.SCHEMA_VERSION))),
        ("dlq_id", record.not_text("dlq_id", is_uuid)),
        ("original_topic", record.not_text("original_topic", _one_of([fixed.EVENT_TOPIC, fixed.PRODUCT_TOPIC]))),
        *_source_rules(record, [*fixed.EVENT_FILES.values(), fixed.PRODUCT_FILE]),
        *_replay_rules(record, "failed_at"),
        ("error_keys", record.not_object("error", ["stage", "type", "message"])),
        ("error_stage", record.not_text("error.stage", _one_of(stages))),
        ("error_type", record.not_text("error.type", _non_empty)),
        ("error_message", record.not_text("error.message", _non_empty)),
        ("raw_record", record.keys("raw_record").isNull()),
    ])


_WHOLE = r"(BIGINT|DECIMAL\([0-9]+,0\))"


def _shape(fields: dict) -> str:
    """Pattern of the schema text of an object; VARIANT objects list their keys in order."""
    return "OBJECT<" + ", ".join(f"{name}: {kind}" for name, kind in sorted(fields.items())) + ">"


def _one_of_shapes(*shapes) -> str:
    return "(" + "|".join(shapes) + ")"


_SOURCE_SHAPE = _shape({"dataset": "STRING", "file": "STRING", "row_number": _WHOLE})
_REPLAY_SHAPE = _shape({"run_id": "STRING", "published_at": "STRING"})

# Per kind: rules, the declared shape, and the struct its values are read into.
CONTRACTS = {
    "event": (
        _event_errors,
        _shape({
            **dict.fromkeys(["schema_version", "event_id", "event_type", "event_time"], "STRING"),
            "event_time_timezone": "VOID",
            "client_id": _WHOLE,
            "payload": _one_of_shapes(
                _shape({"sku": _WHOLE}), _shape({"url_id": _WHOLE}), _shape({"query_vector_raw": "STRING"})
            ),
            "source": _SOURCE_SHAPE,
            "replay": _REPLAY_SHAPE,
        }),
        "struct<schema_version:string,event_id:string,event_type:string,event_time:string,"
        "client_id:decimal(38,0),"
        "payload:struct<sku:decimal(38,0),url_id:decimal(38,0),query_vector_raw:string>,"
        "source:struct<dataset:string,file:string,row_number:decimal(38,0)>,"
        "replay:struct<run_id:string,published_at:string>>",
    ),
    "product": (
        _product_errors,
        _shape({
            **dict.fromkeys(["schema_version", "record_id", "name_vector_raw"], "STRING"),
            **dict.fromkeys(["sku", "category_id", "price_bucket"], _WHOLE),
            "source": _SOURCE_SHAPE,
            "replay": _REPLAY_SHAPE,
        }),
        "struct<schema_version:string,record_id:string,name_vector_raw:string,sku:decimal(38,0),"
        "category_id:decimal(38,0),price_bucket:decimal(38,0),"
        "source:struct<dataset:string,file:string,row_number:decimal(38,0)>,"
        "replay:struct<run_id:string,published_at:string>>",
    ),
    "dlq": (
        _dlq_errors,
        _shape({
            **dict.fromkeys(["schema_version", "dlq_id", "original_topic"], "STRING"),
            "error": _shape(dict.fromkeys(["stage", "type", "message"], "STRING")),
            "source": _SOURCE_SHAPE,
            "replay": _shape({"run_id": "STRING", "failed_at": "STRING"}),
            # Open object: anything may be inside.
            "raw_record": "OBJECT<.*>",
        }),
        "struct<schema_version:string,dlq_id:string,original_topic:string,"
        "error:struct<stage:string,type:string,message:string>,"
        "source:struct<dataset:string,file:string,row_number:decimal(38,0)>,"
        "replay:struct<run_id:string,failed_at:string>>",
    ),
}


def add_contract_errors(df: DataFrame, kind: str, json_text: Column, name: str) -> DataFrame:
    """Add ``name``: the broken rule codes of the JSON text, empty when it is valid."""
    rules, shape, struct = CONTRACTS[kind]
    parsed = add_once(df, "_root", F.try_parse_json(json_text))
    shaped = F.schema_of_variant("_root").rlike(f"^{shape}$")
    if kind == "dlq":
        # The pattern of the open object would also take a key that follows it: the names are compared exactly.
        names = F.array(*[F.lit(name) for name in sorted(_DLQ_KEYS)])
        shaped = shaped & (F.array_sort(F.json_object_keys(json_text)) == names)
    read = add_once(parsed, "_doc", F.when(shaped, F.try_variant_get("_root", "$", struct)))
    by_path = rules(_AnyRecord(F.col("_root")))
    return _add_codes(read, rules, "_doc", by_path, name).drop("_root", "_doc")


def _add_codes(df: DataFrame, rules, doc: str, otherwise: Column, name: str) -> DataFrame:
    """Add ``name``: the codes of the shaped record in column ``doc``, or those of ``otherwise`` where it is null.

    Nearly all records break no rule. That is found out first, by an expression that
    is compiled; the codes, which are not, are asked of the other records only.
    """
    fine = F.col(doc).isNotNull() & ~rules(_ShapedRecord(F.col(doc), any_failure))
    codes = F.when(F.col("_fine"), no_codes()).when(F.col(doc).isNotNull(), rules(_ShapedRecord(F.col(doc)))).otherwise(otherwise)
    return add_once(add_once(df, "_fine", fine), name, codes).drop("_fine")


def _fits(given, declared) -> bool:
    """Whether a struct has the declared fields, with whole numbers where the declaration has them."""
    if isinstance(declared, T.StructType):
        return isinstance(given, T.StructType) and all(
            field.name in given.names and _fits(given[field.name].dataType, field.dataType) for field in declared)
    if isinstance(declared, T.StringType):
        return isinstance(given, T.StringType)
    return isinstance(given, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def add_built_errors(df: DataFrame, kind: str, record: str, json_text: Column, name: str) -> DataFrame:
    """``add_contract_errors`` for records that were built here: the column ``record`` holds the fields that ``json_text`` was made of.

    Fields of the declared types need not be read back from the text to be judged.
    Other types are judged by the text. A null record is no object.
    """
    rules, _, struct = CONTRACTS[kind]
    if not _fits(df.schema[record].dataType, T._parse_datatype_string(struct)):
        return add_contract_errors(df, kind, json_text, name)
    return _add_codes(df, rules, record, F.array(F.lit("not_an_object")), name)


def feature_row_errors(df, counts, recencies):
    """Broken rules per row of a scoring input; its columns are checked on the schema."""
    wanted, present = {*counts, *recencies}, set(df.columns)
    missing = sorted(wanted - present)
    if missing:
        raise ValueError(f"The scoring input lacks {', '.join(missing)}")
    rules = []
    for name in [*counts, *recencies]:
        value = F.col(name).cast("double")
        infinite = value.isin(float("inf"), float("-inf"))
        rules.append((f"{name}_not_finite", value.isNull() | F.isnan(value) | infinite))
        rules.append((f"{name}_negative", ~F.isnan(value) & (value < 0)))
        if name in counts:
            rules.append((f"{name}_not_whole", ~F.isnan(value) & ~infinite & (value != F.rint(value))))
    return all_failures(rules)


def unexpected_columns(df, counts, recencies, keys=()) -> list[str]:
    """Columns a scoring input must not have."""
    return sorted(set(df.columns) - {*counts, *recencies, *keys})
