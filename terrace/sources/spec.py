"""What a source is: its reader, its options and the raw table it lands in."""

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class SourceSpec:
    name: str
    options: Mapping[str, Any]
    type: str = "file"
    namespace: str = "bronze"
    table: str = ""
    partition_by: tuple[str, ...] = ()
    enabled: bool = True
    description: str | None = None
    owner: str | None = None
    tags: tuple[str, ...] = field(default=())

    @property
    def target(self) -> str:
        return f"{self.namespace}.{self.table or self.name}"

    def need(self, *keys: str) -> list[Any]:
        """Option values that must be present and non-empty."""
        missing = [k for k in keys if self.options.get(k) in (None, "")]
        if missing:
            raise ValueError(f"[{self.name}] {self.type} source needs option(s) {missing}")
        return [self.options[k] for k in keys]


# Types of the options that a registry file may give (the contract checks that texts of
# counts are numbers).
OPTION_TYPES = {
    "path": (str,), "format": (str,), "recursive_lookup": (bool,), "reader_options": (Mapping,),
    "url": (str,), "driver": (str,), "user_env": (str,), "password_env": (str,), "dbtable": (str,),
    "query": (str,), "partition_column": (str,), "lower_bound": (str, int),
    "upper_bound": (str, int), "num_partitions": (int, str), "fetch_size": (int, str),
}


def _is(value, kinds: tuple) -> bool:
    """Whether an option is absent or of one of the kinds; a boolean is no number."""
    if value is None:
        return True
    return isinstance(value, kinds) and (bool in kinds or not isinstance(value, bool))


def _texts(value) -> bool:
    return isinstance(value, list | tuple) and all(isinstance(v, str) for v in value)


def spec_from(entry: Mapping[str, Any]) -> SourceSpec:
    """One registry entry (``target`` nested as in YAML) as a specification."""
    entry = dict(entry)
    target = entry.pop("target", None) or {}
    absent = {"name", "type", "options"} - set(entry)
    absent |= {f"target.{k}" for k in ("namespace", "table") if not target.get(k)}
    unknown = set(entry) - {f.name for f in fields(SourceSpec)} | set(target) - {"namespace", "table"}
    if absent or unknown:
        raise ValueError(f"[{entry.get('name')}] missing {sorted(absent)}, unknown {sorted(unknown)}")
    wrong = [k for k in ("name", "type", "description", "owner") if not isinstance(entry.get(k, ""), str | None)]
    wrong += [f"target.{k}" for k in target if not isinstance(target[k], str)]
    wrong += [k for k in ("partition_by", "tags") if not _texts(entry.get(k, []))]
    wrong += [k for k in ("enabled",) if not isinstance(entry.get(k, True), bool)]
    if not isinstance(entry["options"], Mapping):
        wrong.append("options")
    else:
        wrong += [f"options.{k}" for k, kinds in OPTION_TYPES.items() if not _is(entry["options"].get(k), kinds)]
        more = entry["options"].get("reader_options")
        if isinstance(more, Mapping):
            wrong += [f"options.reader_options.{k}" for k, v in more.items() if not _is(v, (str, int, float, bool))]
    if wrong:
        raise ValueError(f"[{entry.get('name')}] of the wrong type: {sorted(wrong)}")
    for listed in ("partition_by", "tags"):
        entry[listed] = tuple(entry.get(listed) or ())
    return SourceSpec(**entry, **target)
