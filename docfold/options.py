"""User options. Defaults are the documented ones.

`batch_size`, `bulk_size_bytes` and `retry_timeout_ms` tune a client's requests. There is no client here, so they are
checked and have no effect; they are accepted so that an existing configuration loads.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

NAMING = ("TOPIC", "STATIC", "TOPIC_REGEX")
WRITE_METHODS = ("INDEX", "UPSERT", "ATOMIC_UPDATE")
ID_STRATEGIES = ("KAFKA_KEY", "RECORD_FIELD", "TOPIC_PARTITION_OFFSET", "UUID")
NULL_VALUES = ("ignore", "delete", "fail")
MALFORMED = ("ignore", "warn", "fail")
RESOURCE_USAGE = ("UNUSED", "REQUIRED", "AUTO")


@dataclass(frozen=True)
class FoldOptions:
    # routing
    collection: str = ""
    collection_naming_strategy: str = "TOPIC"
    # identity
    id_strategy: str = "KAFKA_KEY"
    id_field: str = "id"
    id_coerce_to_string: bool = True
    use_autogenerated_ids: bool = False
    key_ignore: bool = False
    topic_key_ignore: tuple[str, ...] = ()
    # schema
    schema_ignore: bool = False
    topic_schema_ignore: tuple[str, ...] = ()
    schema_auto_create: bool = False
    schema_auto_evolve: bool = False
    external_resource_usage: str = "AUTO"
    compact_map_entries: bool = True
    # stamps
    mapping_version: str = ""
    offset_version_field: str = ""
    external_version_header: str = ""
    source_field: str = ""
    source_exclude_fields: tuple[str, ...] = ()
    # writes
    write_method: str = "INDEX"
    behavior_on_null_values: str = "ignore"
    behavior_on_malformed_documents: str = "fail"
    drop_invalid_message: bool = False
    batch_size: int = 2000
    bulk_size_bytes: int = 5 * 1024 * 1024
    retry_timeout_ms: int = 600_000
    dry_run: bool = False

    def __post_init__(self):
        def put(name, value):
            object.__setattr__(self, name, value)

        # Unknown naming strategies act as TOPIC; every other enumeration rejects what it does not know.
        naming = (self.collection_naming_strategy or "").upper()
        put("collection_naming_strategy", naming if naming in NAMING else "TOPIC")
        for name, allowed, fold in (
            ("write_method", WRITE_METHODS, str.upper),
            ("id_strategy", ID_STRATEGIES, str.upper),
            ("external_resource_usage", RESOURCE_USAGE, str.upper),
            ("behavior_on_null_values", NULL_VALUES, str.lower),
            ("behavior_on_malformed_documents", MALFORMED, str.lower),
        ):
            value = fold(getattr(self, name).strip())
            if value not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {value!r}")
            put(name, value)
        if self.use_autogenerated_ids:
            put("id_strategy", "UUID")
        if self.drop_invalid_message:
            put("behavior_on_malformed_documents", "ignore")
        if self.batch_size < 1:
            raise ValueError("batch_size must be >= 1")
        if self.offset_version_field and self.write_method != "INDEX":
            raise ValueError("offset_version_field makes deletes tombstone documents, so it needs write_method=INDEX")
        if self.collection_naming_strategy == "TOPIC_REGEX" and "=>" not in self.collection:
            raise ValueError("collection has no '=>': under TOPIC_REGEX it is a pattern, '=>' and what replaces a match")
        if self.retry_timeout_ms < -1:
            raise ValueError("retry_timeout_ms must be >= -1")

    @classmethod
    def from_properties(cls, props: dict[str, str]) -> "FoldOptions":
        """Build from dotted property names (``write.method=UPSERT``), values as text."""
        known = {f.name: f for f in fields(cls)}
        values = {}
        for dotted, text in props.items():
            name = dotted.replace(".", "_")
            # A property may carry the name of a product or a part in front: `x.collection` is `collection`.
            while name not in known and "_" in name:
                name = name.partition("_")[2]
            if name not in known:
                raise ValueError(f"unknown option {dotted}")
            default = known[name].default
            if isinstance(default, bool):
                values[name] = text.strip().lower() == "true"
            elif isinstance(default, int):
                values[name] = int(text)
            elif isinstance(default, tuple):
                values[name] = tuple(p.strip() for p in text.split(",") if p.strip())
            else:
                values[name] = text
        return cls(**values)

    @property
    def partial(self) -> bool:
        return self.write_method != "INDEX"
