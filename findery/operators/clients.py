"""Generators for ``answers.generate``: a chat service over HTTP, and a model on the worker.

A generator is made once per task and asked with a system text, a prompt and a number of tokens. It
knows its ``name``, under which a ledger keeps what it said, and how many requests of a task it may
be sent at once (``parallel``). What goes wrong is raised as RuntimeError, and told in its row:
requests that may succeed later (``AGAIN``, broken connections) are sent again after a growing pause,
or after the time that the service asks for, until ``tries`` or the row's ``seconds`` are used up.
"""

from __future__ import annotations

import http.client
import json
import random
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from typing import Any
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# How the service is asked, and where its replies and those of a local model have their text.
ENDPOINT, SAMPLING, SECONDS = "/chat/completions", {"temperature": 0, "frequency_penalty": 0.25}, 120
GREEDY = {"do_sample": False, "temperature": None, "top_p": None}
SERVICE_TEXT, LOCAL_TEXT = ("choices", 0, "message", "content"), (0, "generated_text", -1, "content")

AGAIN = frozenset({408, 425, 429, 500, 502, 503, 504})
PARALLEL, TRIES, PAUSE = 8, 4, 0.5


def turns(system: str, prompt: str) -> list[dict[str, str]]:
    return [{"role": role, "content": text} for role, text in (("system", system), ("user", prompt))]


def text_at(reply: Any, place: tuple) -> str:
    """The text at a place in a reply, stripped; null is empty. A reply of another shape is an error that says where it ends."""
    for n, step in enumerate(place):
        fits = isinstance(reply, dict) and step in reply if isinstance(step, str) else isinstance(reply, list) and bool(reply)
        if not fits:
            raise RuntimeError(f"malformed reply: nothing at {'/'.join(map(str, place[: n + 1]))}")
        reply = reply[step]
    if reply is not None and not isinstance(reply, str):
        raise RuntimeError(f"malformed reply: no text at {'/'.join(map(str, place))}")
    return (reply or "").strip()


@dataclass
class Service:
    """A service that answers POST ``base_url``/chat/completions, and connections to it, one for each thread."""

    base_url: str
    model: str
    key: str | None
    seconds: float = SECONDS
    tries: int = TRIES
    pause: float = PAUSE
    held: threading.local = field(default_factory=threading.local, repr=False)

    def __call__(self, system: str, prompt: str, tokens: int) -> str:
        if not self.key:
            raise RuntimeError("the service's key is empty")
        body = json.dumps({"model": self.model, "messages": turns(system, prompt), "max_tokens": tokens} | SAMPLING).encode()
        raw = self._asked(body)
        try:
            reply = json.loads(raw)
        except ValueError:
            raise RuntimeError(f"malformed reply: {raw[:200].decode(errors='replace')}") from None
        return text_at(reply, SERVICE_TEXT)

    def _asked(self, body: bytes) -> bytes:
        until, failed = time.monotonic() + self.seconds, "no answer"
        for n in range(self.tries):
            left = until - time.monotonic()
            if left <= 0:
                break
            wait = self.pause * 2**n * random.uniform(0.5, 1)
            try:
                status, after, raw = self._sent(body, left)
                if status < 300:
                    return raw
                failed = f"HTTP {status}: {raw.decode(errors='replace')}"
                if status not in AGAIN:
                    break
                wait = max(wait, float(after)) if after and after.isdigit() else wait
            except (OSError, http.client.HTTPException) as e:
                self._drop()
                failed = f"no answer: {e}"
            if n + 1 == self.tries or time.monotonic() + wait >= until:
                break
            time.sleep(wait)
        raise RuntimeError(failed)

    def _sent(self, body: bytes, left: float) -> tuple[int, str | None, bytes]:
        to = urlsplit(self.base_url)
        wire = getattr(self.held, "wire", None)
        if wire is None:
            kind = http.client.HTTPSConnection if to.scheme == "https" else http.client.HTTPConnection
            wire = self.held.wire = kind(to.hostname, to.port, timeout=left)
        wire.timeout = left
        if wire.sock is not None:
            wire.sock.settimeout(left)
        wire.request("POST", to.path.rstrip("/") + ENDPOINT, body, {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        got = wire.getresponse()
        out = got.status, got.headers.get("Retry-After"), got.read()
        if got.will_close:
            self._drop()
        return out

    def _drop(self) -> None:
        wire = getattr(self.held, "wire", None)
        if wire is not None:
            wire.close()
            self.held.wire = None


@dataclass
class Local:
    """A text generation pipeline on the worker, asked for the likeliest words; ``load`` makes it when the first prompt comes."""

    load: Callable[[], Callable]

    @cached_property
    def pipeline(self) -> Callable:
        return self.load()

    def __call__(self, system: str, prompt: str, tokens: int) -> str:
        return text_at(self.pipeline(turns(system, prompt), max_new_tokens=tokens, **GREEDY), LOCAL_TEXT)


@dataclass(frozen=True)
class Generator:
    """Makes a task's ``speak``: (system, prompt, tokens) -> text."""

    make: Callable[[], Callable[[str, str, int], str]]
    name: str = ""
    parallel: int = 1

    def __call__(self) -> Callable[[str, str, int], str]:
        return self.make()


def http_chat(base_url: str, model: str, key: str | None, seconds: float = SECONDS, parallel: int = PARALLEL, tries: int = TRIES, pause: float = PAUSE) -> Generator:
    return Generator(lambda: Service(base_url, model, key, seconds, tries, pause), f"{base_url.rstrip('/')} {model}", parallel)


def local_chat(load: Callable[[], Callable], name: str = "local") -> Generator:
    return Generator(lambda: Local(load), name)


def of(spark: SparkSession, load: Callable[[str], Callable] | None = None) -> Generator | None:
    """The generator that the session names: ``spark.findery.generator`` is ``http``, ``local`` or unset (none), with ``.url``, ``.model``, ``.key`` and ``.parallel`` beside it. ``load(model)`` makes a local pipeline."""
    get = lambda name, default=None: spark.conf.get(f"spark.findery.generator{name}", default)
    kind, model = get("", ""), get(".model", "")
    if not kind:
        return None
    if kind == "http":
        return http_chat(get(".url"), model, get(".key", ""), parallel=int(get(".parallel", str(PARALLEL))))
    if kind != "local":
        raise RuntimeError(f"no generator is called {kind!r}")
    if load is None:
        raise RuntimeError("a local generator needs a function that loads its model")
    return local_chat(lambda: load(model), model)
