"""Strictly typed configuration of a run, and prices. Small files, read on the driver."""

from __future__ import annotations

import json
import os
import shutil
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from ledgerloom.operators import schedule

# Version, provider types, policies, and each section's fields: kind, default (... for none), least.
VERSION = 1
PROVIDER_TYPES = ("fake", "deepseek", "gemini", "local_teacher", "bedrock")
NEED_MODEL = ("deepseek", "gemini", "bedrock")
STRUCTURED = ("gemini", "bedrock")
POLICIES = ("first_valid_then_score",)
SECTIONS = {
    "input_generation": {"enabled": (bool, True), "target_inputs": (int, 0, 0), "batch_size": (int, 100, 1), "dedupe": (bool, True)},
    "output_generation": {"enabled": (bool, True), "label_attempts_per_input": (int, 1, 1), "selection_policy": (str, "first_valid_then_score")},
    "validation": {
        "schema": (bool, True), "semantic_validator": (bool, True), "reject_invalid": (bool, True),
        "retry_invalid_with_stricter_prompt": (bool, False), "max_repair_attempts": (int, 0, 0),
    },
    "rate_limits": {"global_max_workers": (int, 8, 1), "write_flush_every": (int, 50, 1)},
}
PROVIDER = {
    "name": (str, ""), "type": (str, ...), "weight": (int, 1, 1), "threads": (int, 1, 1), "model": (str, None), "temperature": (float, None, 0),
    "max_tokens": (int, None, 1), "max_retries": (int, 3, 0), "structured_output": (bool, False), "seed": (int, None), "fixture_inputs": (str, None),
    "fixture_labels": (str, None), "region": (str, None), "thinking_budget_tokens": (int, None, 1), "cache_system_prompt": (bool, False),
}


class ConfigError(ValueError):
    """Names the field that is wrong."""


def typed(value, kind: type, path: str):
    """The value if it is of the kind; a boolean is no number, a whole number is a float."""
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or (kind in (int, float) and isinstance(value, bool)):
        raise ConfigError(f"{path}: expected {kind.__name__}, got {type(value).__name__}")
    return value


@dataclass(frozen=True)
class Section:
    """The values of one object of the configuration, as attributes."""

    values: dict = field(default_factory=dict)

    def __getattr__(self, name: str):
        try:
            return self.__dict__["values"][name]
        except KeyError:
            raise AttributeError(name) from None


def _read(raw, fields: dict[str, tuple], path: str, others: Sequence[str] = ()) -> dict:
    """The fields of an object, each typed, within its bound, or its default."""
    typed(raw, dict, path)
    for key in raw:
        if key not in fields and key not in others:
            warnings.warn(f"{path}.{key}: unknown field", stacklevel=3)
    out = {}
    for name, (kind, default, *least) in fields.items():
        value = raw.get(name, default)
        if value is ...:
            raise ConfigError(f"{path}.{name}: missing")
        if value is not None or default is not None:
            value = typed(value, kind, f"{path}.{name}")
            if least and value < least[0]:
                raise ConfigError(f"{path}.{name}: less than {least[0]}")
        out[name] = value
    return out


def _fixture(value: str | None, folder: str, path: str) -> str | None:
    """The absolute path of a fixture; relative ones start at the configuration's folder."""
    if value is None:
        return None
    at = os.path.realpath(os.path.join(folder, value))
    if not os.path.isfile(at):
        raise ConfigError(f"{path}: no file at {at}")
    return at


def _providers(raw, section: str, folder: str) -> tuple[Section, ...]:
    """The providers of a section: names differ, and each type has what it needs."""
    out: list[Section] = []
    wants = {"input_generation": "fixture_inputs", "output_generation": "fixture_labels"}[section]
    for k, item in enumerate(typed(raw, list, f"{section}.providers")):
        at = f"{section}.providers[{k}]"
        own = _read(item, PROVIDER, at)
        for name in ("fixture_inputs", "fixture_labels"):
            own[name] = _fixture(own[name], folder, f"{at}.{name}")
        faults = (
            (not own["name"], ".name: empty"),
            (own["name"] in {p.name for p in out}, f".name: {own['name']!r} twice"),
            (own["type"] not in PROVIDER_TYPES, f".type: {own['type']!r} is none of {', '.join(PROVIDER_TYPES)}"),
            (own["type"] == "fake" and not own[wants], f".{wants}: required for fake"),
            (own["type"] in NEED_MODEL and not own["model"], f".model: required for {own['type']}"),
        )
        for wrong, what in faults:
            if wrong:
                raise ConfigError(at + what)
        if own["structured_output"] and own["type"] not in STRUCTURED:
            warnings.warn(f"{at}.structured_output: has no effect on {own['type']}", stacklevel=4)
        out.append(Section(own))
    return tuple(out)


def load_generation(text: str, folder: str = ".", source: str | None = None) -> Section:
    """The configuration of a generation run: sections as attributes, checked field by field, then across fields."""
    try:
        raw = json.loads(text)
    except ValueError as error:
        raise ConfigError(f"{source or 'config'}: invalid JSON: {error}") from None
    raw = typed(raw, dict, "config")
    version = raw.get("version", VERSION)
    if isinstance(version, bool) or version != VERSION:
        raise ConfigError(f"version: {version!r} is not supported, only {VERSION}")
    for key in raw.keys() - SECTIONS.keys() - {"version"}:
        warnings.warn(f"{key}: unknown section", stacklevel=2)
    out: dict = {"version": version, "source": source}
    for name, fields in SECTIONS.items():
        own = raw.get(name, {})
        values = _read(own, fields, name, ("providers", "provider_priority"))
        if name.endswith("_generation"):
            values["providers"] = _providers(own.get("providers", []), name, folder)
        if name == "output_generation":
            listed = typed(own.get("provider_priority", []), list, f"{name}.provider_priority")
            values["provider_priority"] = tuple(typed(x, str, f"{name}.provider_priority") for x in listed)
        out[name] = Section(values)
    config = Section(out)
    inputs, outputs = config.input_generation, config.output_generation
    if inputs.enabled and inputs.target_inputs and not inputs.providers:
        raise ConfigError("input_generation.providers: empty, but inputs are wanted")
    if outputs.selection_policy not in POLICIES:
        raise ConfigError(f"output_generation.selection_policy: {outputs.selection_policy!r} is none of {', '.join(POLICIES)}")
    if outputs.enabled and not outputs.providers:
        raise ConfigError("output_generation.providers: empty, but enabled")
    for name in outputs.provider_priority:
        if name not in {p.name for p in outputs.providers}:
            raise ConfigError(f"output_generation.provider_priority: no provider {name!r}")
    return config


def load_generation_file(path: str) -> Section:
    if not os.path.isfile(path):
        raise ConfigError(f"no configuration at {path}")
    with open(path, encoding="utf-8") as f:
        return load_generation(f.read(), os.path.dirname(os.path.abspath(path)), path)


def priority_map(outputs: Section) -> dict[str, int]:
    """Rank of each provider: as listed, or else as declared."""
    return {n: k for k, n in enumerate(outputs.provider_priority or [p.name for p in outputs.providers])}


def dry_run(config: Section, preview: int = 10) -> str:
    """What a run would do, as text: quotas, the first turns of the schedule, and limits. Nothing runs."""
    inputs, outputs = config.input_generation, config.output_generation
    lines = ["Multi-provider dry run", f"Config: {config.source or '<unknown>'}  (version {config.version})", ""]
    said = lambda p: f"    {p.name}  type={p.type}  weight={p.weight}  threads={p.threads}"
    listed = lambda section, names: [f"  {n}: {getattr(section, n)}" for n in names]
    state = lambda section: "enabled" if section.enabled else "disabled"
    lines.append(f"Input generation: {state(inputs)}")
    if inputs.enabled:
        quotas = schedule.quota_of([p.weight for p in inputs.providers], inputs.target_inputs)
        lines += [*listed(inputs, ("target_inputs", "batch_size", "dedupe")), "  providers:", *(f"{said(p)}  quota={n}" for p, n in zip(inputs.providers, quotas, strict=True))]
    lines += ["", f"Output generation: {state(outputs)}"]
    if outputs.enabled:
        first = " ".join(outputs.provider_priority) or "(default declaration order)"
        turns = schedule.turns([p.weight for p in outputs.providers])
        lines += [*listed(outputs, ("label_attempts_per_input", "selection_policy")), f"  provider_priority: {first}", "  providers:", *map(said, outputs.providers)]
        lines.append(f"  scheduler preview (first {preview}): " + " ".join(outputs.providers[turns[k % len(turns)]].name for k in range(preview)))
    for title, name in (("Validation gate:", "validation"), ("Execution limits:", "rate_limits")):
        lines += ["", title, *listed(getattr(config, name), SECTIONS[name])]
    return "\n".join([*lines, "", "Execution: not started. This was a dry run."])


def registry(makers: dict[str, Callable]) -> Callable[[Section], object]:
    """A factory of label sources by type; a type without a maker is an error that names it."""

    def make(provider: Section):
        if provider.type not in makers:
            raise ConfigError(f"{provider.name}: no source for type {provider.type!r}")
        return makers[provider.type](provider)

    return make


def template(path: str) -> str:
    """A prompt template; a missing file is an error."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"no prompt template at {path}")
    with open(path, encoding="utf-8") as f:
        return f.read()


def copy_if_newer(source: str, to: str, force: bool = False) -> bool:
    """Copies a file unless the other is as new; whether it did."""
    if not force and os.path.exists(to) and os.path.getmtime(to) >= os.path.getmtime(source):
        return False
    os.makedirs(os.path.dirname(os.path.abspath(to)), exist_ok=True)
    shutil.copy2(source, to)
    return True


class Fresh:
    """What load(path) gives, kept until the file's time of change is another."""

    def __init__(self, load: Callable[[str], object]) -> None:
        self.load, self.held = load, {}

    def __call__(self, path: str):
        changed = os.stat(path).st_mtime_ns
        if self.held.get(path, (None,))[0] != changed:
            self.held[path] = (changed, self.load(path))
        return self.held[path][1]


def lines_of(path: str) -> tuple[list, int]:
    """Objects of a small JSON Lines file, and how many lines are none. For Fresh, beside a view of a file."""
    rows, bad = [], 0
    with open(path, encoding="utf-8") as f:
        for line in filter(str.strip, f):
            try:
                rows.append(json.loads(line))
            except ValueError:
                bad += 1
    return rows, bad


def write_json(value: dict, path: str) -> None:
    """Keys in order, two spaces a level."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True)
        f.write("\n")


def load_prices(text: str | None) -> dict[str, tuple[float, float]]:
    """key -> price of a million tokens in and out. No file: everything is free."""
    if text is None:
        return {"default": (0.0, 0.0)}
    out = {}
    for key, entry in typed(json.loads(text), dict, "prices").items():
        typed(entry, dict, f"prices.{key}")
        pair = []
        for name in ("input_per_million", "output_per_million"):
            if name not in entry:
                raise ConfigError(f"prices.{key}.{name}: missing")
            pair.append(typed(entry[name], float, f"prices.{key}.{name}"))
        if min(pair) < 0:
            raise ConfigError(f"prices.{key}: negative")
        for extra in sorted(entry.keys() - {"input_per_million", "output_per_million"}):
            warnings.warn(f"prices.{key}.{extra}: unknown key", stacklevel=2)
        out[key] = (pair[0], pair[1])
    return out
