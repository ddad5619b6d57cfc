"""Sources and sinks: payment log, dictionaries, stored panels."""

from ledgerlens.sources.dictionary import (
    bounded,
    dictionary_long,
    fixture_dictionary,
    read_dictionaries,
    read_dictionary,
)
from ledgerlens.sources.panel import read_panel, write_panel
from ledgerlens.sources.payments import derive_payments, read_payments, stored_payments, table

__all__ = [
    "bounded",
    "derive_payments",
    "dictionary_long",
    "fixture_dictionary",
    "read_dictionaries",
    "read_dictionary",
    "read_panel",
    "read_payments",
    "stored_payments",
    "table",
    "write_panel",
]
