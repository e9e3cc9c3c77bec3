"""What generators have said, kept in a folder that all workers reach, one file for each request.

A request's key is a hash of the generator's name, the system text, the prompt and the number of
tokens. An answer is written beside its place and moved there whole, so a reader finds all of it or
none; of two writers of one key either's answer stands. A task that is run again, a batch that is
replayed and a prompt that comes twice find what was said before and ask nothing. Errors aren't kept.

The folder is a path, or a URI of a file system that pyarrow opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyarrow import fs


def key_of(name: str, system: str, prompt: str, tokens: int) -> str:
    return hashlib.sha256(json.dumps([name, system, prompt, tokens], ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()


class Ledger:
    def __init__(self, folder: str):
        if folder.startswith("file:"):
            folder = "/" + folder.removeprefix("file:").lstrip("/")
        self.files, self.root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))

    def _place(self, key: str) -> str:
        return f"{self.root}/{key[:2]}/{key}.json"

    def get(self, key: str) -> str | None:
        """What was said, or None. A file that can't be read as one of ours counts as none."""
        try:
            with self.files.open_input_file(self._place(key)) as f:
                return json.loads(f.read())["said"]
        except (FileNotFoundError, ValueError, KeyError, TypeError):
            return None

    def put(self, key: str, said: str) -> None:
        place = self._place(key)
        self.files.create_dir(place.rpartition("/")[0], recursive=True)
        new = f"{place}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(new) as f:
            f.write(json.dumps({"said": said}).encode())
        self.files.move(new, place)
