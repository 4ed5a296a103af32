"""Model clients: protocols, deterministic offline ones, adapters and configuration."""

from __future__ import annotations

import hashlib
import json
import os
import re
import textwrap
import urllib.request
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

STOPPED_SHORT = ("max_tokens", "length")


@dataclass(frozen=True)
class Completion:
    text: str
    tokens_in: int | None = None
    tokens_out: int | None = None
    stop_reason: str | None = None

    @property
    def truncated(self) -> bool:
        return self.stop_reason in STOPPED_SHORT


class ClientError(RuntimeError):
    """The provider failed; the call isn't repeated."""


class CompletionClient(Protocol):
    def complete(self, system: str, user: str, *, max_tokens: int) -> Completion: ...


class EmbeddingClient(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class KeywordClient:
    """Offline completions: the document's first sentence as summary and its written technique ids with their sentence as quote."""

    def complete(self, system: str, user: str, *, max_tokens: int) -> Completion:
        text = re.sub(r"<<<[A-Z ]+>>>\n?", "", user)
        summary = " ".join(text.split())[:200].strip() or "empty document"
        techniques = [{"technique_id": t, "evidence_quote": s.strip()[:900]} for s in re.split(r"(?<=[.!?])\s+", text) for t in re.findall(r"\bT[0-9]{4}(?:\.[0-9]{3})?\b", s) if s.strip()]
        out = json.dumps({"summary": summary, "confidence": "low", "techniques": techniques})
        return Completion(out, len(user) // 4, len(out) // 4, "end_turn")


class ScriptedClient:
    """Answers in order; an exception in the script is raised."""

    def __init__(self, answers: list):
        self.answers, self.asked = list(answers), []

    def complete(self, system: str, user: str, *, max_tokens: int) -> Completion:
        self.asked.append(user)
        now = self.answers.pop(0)
        if isinstance(now, Exception):
            raise now
        return now if isinstance(now, Completion) else Completion(now, 10, 5, "end_turn")


class HashEmbedder:
    """Offline embeddings: signs and sizes from a hash of the text, the same on every run."""

    def __init__(self, width: int = 64):
        self.width = width

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            raw = hashlib.shake_256(t.encode()).digest(self.width)
            out.append([(b - 127.5) / 127.5 for b in raw])
        return out


class HttpClient:
    """Completions and embeddings of an OpenAI-compatible endpoint; `post(url, body, headers)` may be given."""

    def __init__(self, base_url: str, model: str, api_key: str | None = None, timeout: float = 60, post=None):
        self.base, self.model, self.key, self.timeout, self.post = base_url.rstrip("/"), model, api_key, timeout, post or self._post

    def _post(self, url: str, body: dict, headers: dict) -> dict:
        request = urllib.request.Request(url, json.dumps(body).encode(), headers | {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def _call(self, path: str, body: dict) -> dict:
        try:
            return self.post(self.base + path, body, {"Authorization": f"Bearer {self.key}"} if self.key else {})
        except OSError as e:
            raise ClientError(str(e)) from e

    def complete(self, system: str, user: str, *, max_tokens: int) -> Completion:
        got = self._call("/chat/completions", {"model": self.model, "max_tokens": max_tokens, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]})
        try:
            choice, usage = got["choices"][0], got.get("usage") or {}
            return Completion(choice["message"]["content"] or "", usage.get("prompt_tokens"), usage.get("completion_tokens"), choice.get("finish_reason"))
        except (KeyError, IndexError, TypeError) as e:
            raise ClientError("the answer has an odd shape") from e

    def embed(self, texts: list[str]) -> list[list[float]]:
        got = self._call("/embeddings", {"model": self.model, "input": texts})
        try:
            return [r["embedding"] for r in sorted(got["data"], key=lambda r: r["index"])]
        except (KeyError, TypeError) as e:
            raise ClientError("the answer has an odd shape") from e

    def ping(self) -> list[str]:
        """The models that the endpoint lists; a ClientError if it doesn't answer."""
        listed = advertised(self.base, self.key)
        if listed is None:
            raise ClientError(f"{self.base} lists no models")
        return listed


class MessagesClient(HttpClient):
    """Completions of a messages endpoint with a system field."""

    def complete(self, system: str, user: str, *, max_tokens: int) -> Completion:
        body = {"model": self.model, "max_tokens": max_tokens, "system": system, "messages": [{"role": "user", "content": user}]}
        try:
            got = self.post(self.base + "/v1/messages", body, {"x-api-key": self.key or ""})
            usage = got.get("usage") or {}
            return Completion("".join(p.get("text", "") for p in got["content"]), usage.get("input_tokens"), usage.get("output_tokens"), got.get("stop_reason"))
        except OSError as e:
            raise ClientError(str(e)) from e
        except (KeyError, TypeError, AttributeError) as e:
            raise ClientError("the answer has an odd shape") from e


# Token budgets (in, out) of native, hosted and local endpoints.
BUDGETS = {"native": (150_000, 16_000), "hosted": (100_000, 16_000), "local": (6_000, 2_048)}
# Key prefixes, longest first.
KEY_PREFIXES = (("sk-or-v1-", "openrouter"), ("sk-proj-", "openai"), ("sk-ant-", "anthropic"), ("gsk_", "groq"), ("sk-", "openai"))


def provider_of(key: str) -> str | None:
    return next((p for prefix, p in KEY_PREFIXES if key.startswith(prefix)), None)


def positive_int(env: Mapping[str, str], name: str, default: int) -> int:
    """The variable's value if it is a positive integer; a warning and the default otherwise."""
    raw = env.get(name, "").strip()
    if not raw:
        return default
    if raw.isdigit() and int(raw) > 0:
        return int(raw)
    warnings.warn(f"{name} is not a positive integer; using {default}", stacklevel=2)
    return default


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Endpoint:
    provider: str
    base_url: str | None
    model: str | None
    max_input_tokens: int
    max_output_tokens: int
    source: str


def resolve_completion(env: Mapping[str, str] = os.environ, probe=None, discover=None) -> Endpoint:
    """Base address, then key prefix, then what is found on the local machine.

    probe gives a list of models; without it discover (discover_local) gives address and models.
    """
    def get(*names):
        return next((env[n].strip() for n in names if env.get(n, "").strip()), None)

    key, base, model = get("LLM_API_KEY", "ANTHROPIC_API_KEY", "OPENAI_API_KEY"), get("LLM_BASE_URL"), get("LLM_MODEL")
    if base:
        if not model:
            raise ConfigError("LLM_BASE_URL needs LLM_MODEL")
        kind, provider, source = "hosted", "openai_compatible", "LLM_BASE_URL"
    elif key:
        provider = provider_of(key)
        if provider is None:
            raise ConfigError("the key's prefix names no provider; set LLM_BASE_URL")
        kind, source = "native" if provider == "anthropic" else "hosted", "key prefix"
    else:
        base, found = (None, probe()) if probe else (discover or discover_local)() or (None, None)
        models = [m for m in (found or ()) if "embed" not in m.lower()]
        if not models:
            raise ConfigError("no key, no base address and nothing local")
        kind, provider, model, source = "local", "local", model or models[0], "local probe"
    most_in, most_out = BUDGETS[kind]
    return Endpoint(provider, base, model, positive_int(env, "MAX_INPUT_TOKENS", most_in), positive_int(env, "MAX_OUTPUT_TOKENS", most_out), source)


def resolve_embedding(env: Mapping[str, str] = os.environ, probe=None, discover=None) -> Endpoint | None:
    """The embedding endpoint, or None: search is then off; nothing is raised."""
    base, model = env.get("EMBEDDING_BASE_URL", "").strip(), env.get("EMBEDDING_MODEL", "").strip()
    if base and model:
        return Endpoint("openai_compatible", base, model, 0, 0, "EMBEDDING_BASE_URL")
    base, found = (None, probe()) if probe else (discover or discover_local)() or (None, None)
    models = [m for m in (found or ()) if "embed" in m.lower()]
    return Endpoint("local", base, models[0], 0, 0, "local probe") if models else None


# Where hosted providers listen.
PROVIDER_BASES = {"openrouter": "https://openrouter.ai/api/v1", "openai": "https://api.openai.com/v1", "groq": "https://api.groq.com/openai/v1", "anthropic": "https://api.anthropic.com"}


def completion_client(at: Endpoint, env: Mapping[str, str] = os.environ) -> HttpClient:
    """The client of a resolved endpoint, with the environment's key."""
    key = next((env[n].strip() for n in ("LLM_API_KEY", "ANTHROPIC_API_KEY", "OPENAI_API_KEY") if env.get(n, "").strip()), None)
    base = at.base_url or PROVIDER_BASES.get(at.provider)
    if base is None or at.model is None:
        raise ConfigError("the endpoint needs an address and LLM_MODEL a model")
    return (MessagesClient if at.provider == "anthropic" else HttpClient)(base, at.model, key)


def embedding_client(at: Endpoint, env: Mapping[str, str] = os.environ) -> HttpClient:
    if at.base_url is None or at.model is None:
        raise ConfigError("the embedding endpoint needs an address and a model")
    return HttpClient(at.base_url, at.model, env.get("EMBEDDING_API_KEY", "").strip() or None)


# Where a local runtime listens.
LOCAL_ROOTS = ("http://localhost:11434", "http://localhost:8000")


def advertised(root: str, key: str | None = None, timeout: float = 1.0, get=None) -> list[str] | None:
    """Model ids that an endpoint lists, or None whatever goes wrong; a probe never raises."""
    base = root.rstrip("/")
    url = (base if base.endswith("/v1") else f"{base}/v1") + "/models"

    def fetch(url: str, headers: dict):
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as answer:
            return json.load(answer)

    try:
        listed = (get or fetch)(url, {"Authorization": f"Bearer {key}"} if key else {})["data"]
        return [m["id"] for m in listed if isinstance(m, dict) and m.get("id")] if isinstance(listed, list) else None
    except (OSError, ValueError, KeyError, TypeError):
        return None


def discover_local(probe=advertised) -> tuple[str, list[str]] | None:
    """Address and models of the first local runtime that lists any."""
    return next(((f"{root}/v1", models) for root in LOCAL_ROOTS if (models := probe(root))), None)


def resolve_second(env: Mapping[str, str] = os.environ, probe=advertised, discover=discover_local) -> Endpoint:
    """The second backend of an evaluation: a compatible endpoint whose model is known by name, with local budgets."""
    own = {n: env.get(n, "").strip() or None for n in ("EVAL_LOCAL_BASE_URL", "EVAL_LOCAL_MODEL", "EVAL_LOCAL_API_KEY", "LLM_BASE_URL", "LLM_MODEL")}
    base, model = own["EVAL_LOCAL_BASE_URL"] or own["LLM_BASE_URL"], own["EVAL_LOCAL_MODEL"] or own["LLM_MODEL"]
    source = "EVAL_LOCAL_BASE_URL" if own["EVAL_LOCAL_BASE_URL"] else "LLM_BASE_URL"
    if base is None:
        found = discover()
        if found is None:
            raise ConfigError("no second backend: set EVAL_LOCAL_BASE_URL or start a local runtime")
        (base, models), source = found, "local discovery"
    else:
        models = () if model else probe(base, own["EVAL_LOCAL_API_KEY"]) or ()
    model = model or next((m for m in models if "embed" not in m.lower()), None)
    if model is None:
        raise ConfigError(f"{base} names no model to complete with: set EVAL_LOCAL_MODEL")
    most_in, most_out = BUDGETS["local"]
    return Endpoint("openai_compatible", base, model, positive_int(env, "MAX_INPUT_TOKENS", most_in), positive_int(env, "MAX_OUTPUT_TOKENS", most_out), source)


def provider_hint(error: object) -> str:
    """The provider's own words in an error, whole; without any, the error in brief and what to look at."""
    said = re.search(r"'message':\s*'([^']+)'", str(error))
    return said[1] if said else textwrap.shorten(str(error), 120, placeholder=" ...") + " (see the key, the base address and the model's name)"


#: Versioned with the package; changing a file changes prompt_version().
PROMPTS = Path(__file__).parent / "prompts"
SYSTEM_PROMPT = (PROMPTS / "extract_system.md").read_text(encoding="utf-8")


def prompt_version(folder: Path = PROMPTS) -> str:
    """First 12 hex digits of the git tree hash of the prompts' files."""
    tree = b""
    for file in sorted(f for f in folder.iterdir() if f.is_file()):
        raw = file.read_bytes()
        tree += b"100644 " + file.name.encode() + b"\0" + hashlib.sha1(b"blob %d\0" % len(raw) + raw).digest()
    return hashlib.sha1(b"tree %d\0" % len(tree) + tree).hexdigest()[:12]
