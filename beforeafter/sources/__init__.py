"""Panel, event and catalogue sources."""

from beforeafter.sources.documents import catalogue_labels, nested_observations
from beforeafter.sources.files import (
    EmptyInput,
    input_report,
    read_matching,
    require_input,
    schema_of,
)
from beforeafter.sources.panel import (
    between_times,
    drop_valueless,
    observations,
    profile,
    event_rejects,
    ingest_report,
    read_events,
    read_events_text,
    resolve_duplicates,
    tag_source,
    three_capitals,
    unify,
    unpivot_times,
    wanted_entities,
)

__all__ = [
    "EmptyInput",
    "between_times",
    "catalogue_labels",
    "drop_valueless",
    "input_report",
    "nested_observations",
    "observations",
    "profile",
    "event_rejects",
    "ingest_report",
    "read_events",
    "read_events_text",
    "read_matching",
    "require_input",
    "resolve_duplicates",
    "schema_of",
    "tag_source",
    "three_capitals",
    "unify",
    "unpivot_times",
    "wanted_entities",
]
