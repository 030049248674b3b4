"""Named file formats a feed can be configured with."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class FileFormat:
    kind: str  # csv, text, json or parquet
    header: str = "none"  # skip, parse or none
    quote: str = ""
    encoding: str = "windows-1252"
    delimiter: str = ","
    multiline: bool = False  # quoted cells may hold line ends; a file is then one split

    def with_delimiter(self, delimiter: str) -> FileFormat:
        return replace(self, delimiter=delimiter)

    @property
    def has_header(self) -> bool:
        return self.header != "none"


# Format names used by feed configuration and what they mean.
FORMATS = {
    "CSV_FORMAT": FileFormat("csv", header="skip", quote='"', multiline=True),
    "CSV_FORMAT_PARSE_HEADER": FileFormat("csv", header="parse", quote='"', multiline=True),
    "CSV_FORMAT_NO_HEADER": FileFormat("csv", quote='"', multiline=True),
    "CSV_FORMAT_NO_ENCLOSE": FileFormat("csv", header="skip"),
    "CSV_FORMAT_NO_ENCLOSE_PARSE_HEADER": FileFormat("csv", header="parse"),
    "CSV_FORMAT_NO_ENCLOSE_NO_HEADER": FileFormat("csv"),
    "TEXT_FORMAT": FileFormat("text", header="skip"),
    "TEXT_FORMAT_NO_HEADER": FileFormat("text"),
    "JSON_FORMAT": FileFormat("json", encoding="UTF-8"),
    "PARQUET_FORMAT": FileFormat("parquet", encoding="UTF-8"),
}


def get_format(name: str) -> FileFormat:
    try:
        return FORMATS[name]
    except KeyError:
        raise ValueError(f"File Format not found: {name}") from None
