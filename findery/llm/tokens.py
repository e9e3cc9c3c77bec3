"""The byte-level BPE of a public vocabulary file, loaded once per worker."""

from __future__ import annotations

import json
import sys
import types


def _shared() -> dict:
    """A dict that lives as long as the worker process. (Functions sent by value get new globals with each task.)"""
    return sys.modules.setdefault("_findery_worker", types.ModuleType("_findery_worker")).__dict__


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def specials(name: str = "byte_bpe_50k.json") -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file: wherever their strings come in a text, they are one id each."""
    cache = _shared()
    if ("specials", name) not in cache:
        with open(vocabulary(name), encoding="utf-8") as f:
            cache["specials", name] = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return cache["specials", name]


def encoder(name: str = "byte_bpe_50k.json"):
    """text -> ids, those of the ``tokenizers`` file of that name as it is loaded, ``add_special_tokens=False``.

    The same vocabulary is read by ``tiktoken`` from the file of ranks beside it, which gives the
    same ids in a fifth of the time (tests compare them). A text is cut at the strings of special
    tokens first, each of which is its own id; what is between is encoded by itself.
    """
    cache = _shared()
    if ("encoder", name) not in cache:
        import base64

        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(name.replace(".json", ".tiktoken")), "rb"))}
        own = specials(name)
        bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=own)

        def encode(text: str) -> list[int]:
            if any(s in text for s in own):
                return bpe.encode(text, allowed_special="all", disallowed_special=())
            return bpe.encode_ordinary(text)

        cache["encoder", name] = encode
    return cache["encoder", name]


def pretokens(name: str = "byte_bpe_50k.json"):
    """text -> the pieces that special tokens and the vocabulary's pattern cut it into; no token spans two of them."""
    import public_tokenizers
    import regex

    own = specials(name)
    at, cut = regex.compile("(" + "|".join(map(regex.escape, own)) + ")"), regex.compile(public_tokenizers.PATTERN).findall

    def pieces(text: str) -> list[str]:
        if not any(s in text for s in own):
            return cut(text)
        return [p for n, part in enumerate(at.split(text)) for p in ([part] if n % 2 else cut(part))]

    return pieces
