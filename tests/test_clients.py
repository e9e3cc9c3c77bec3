"""Generators against a service on this machine and a stand-in for a local model."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from findery.operators import answers, clients


@pytest.fixture
def service():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, self.headers["Authorization"], body))
            bad = "bad" in body["messages"][1]["content"]
            said = b"too much" if bad else json.dumps({"choices": [{"message": {"content": None if "none" in body["messages"][1]["content"] else "  said  "}}]}).encode()
            self.send_response(429 if bad else 200)
            self.end_headers()
            self.wfile.write(said)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/", seen
    server.shutdown()


def test_http(service):
    url, seen = service
    speak = clients.http_chat(url, "m", "k", pause=0.01)()
    assert speak("s", "p", 7) == "said" and speak("s", "none", 7) == ""
    path, key, body = seen[0]
    assert (path, key) == ("/v1/chat/completions", "Bearer k")
    assert body == {"model": "m", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "p"}], "max_tokens": 7, "temperature": 0, "frequency_penalty": 0.25}
    with pytest.raises(RuntimeError, match="HTTP 429: too much"):
        speak("s", "bad", 7)
    with pytest.raises(RuntimeError, match="key is empty"):
        clients.http_chat(url, "m", "")()("s", "p", 7)
    with pytest.raises(RuntimeError, match="no answer"):
        clients.http_chat("http://127.0.0.1:1", "m", "k", 2, pause=0.01)()("s", "p", 7)


class Turns:
    """A service whose replies are given: (status, headers, body) each, the last one again and again."""

    def __init__(self, *replies, slow=0.0):
        self.seen, self.at_once, self.most, lock = [], 0, 0, threading.Lock()
        turns = self

        class Handler(BaseHTTPRequestHandler):
            protocol_version = "HTTP/1.1"

            def do_POST(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                with lock:
                    turns.seen.append(body["messages"][1]["content"])
                    turns.at_once += 1
                    turns.most = max(turns.most, turns.at_once)
                    status, headers, said = replies[min(len(turns.seen), len(replies)) - 1]
                time.sleep(slow)
                with lock:
                    turns.at_once -= 1
                self.send_response(status)
                for k, v in {**headers, "Content-Length": str(len(said))}.items():
                    self.send_header(k, v)
                self.end_headers()
                self.wfile.write(said)

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/v1"


GOOD = (200, {}, json.dumps({"choices": [{"message": {"content": "said"}}]}).encode())


def test_what_may_succeed_later_is_asked_again():
    s = Turns((503, {}, b"busy"), (429, {"Retry-After": "1"}, b"slow down"), GOOD)
    began = time.monotonic()
    assert clients.http_chat(s.url, "m", "k", pause=0.01)()("s", "p", 7) == "said"
    assert len(s.seen) == 3 and time.monotonic() - began >= 1
    s = Turns((400, {}, b"no"), GOOD)
    with pytest.raises(RuntimeError, match="HTTP 400: no"):
        clients.http_chat(s.url, "m", "k")()("s", "p", 7)
    assert len(s.seen) == 1


def test_a_row_has_a_deadline():
    s = Turns((503, {"Retry-After": "60"}, b"busy"))
    began = time.monotonic()
    with pytest.raises(RuntimeError, match="HTTP 503"):
        clients.http_chat(s.url, "m", "k", seconds=1)()("s", "p", 7)
    assert len(s.seen) == 1 and time.monotonic() - began < 5
    s = Turns(GOOD, slow=3)
    with pytest.raises(RuntimeError, match="no answer"):
        clients.http_chat(s.url, "m", "k", seconds=0.5)()("s", "p", 7)
    assert time.monotonic() - began < 8


@pytest.mark.parametrize(("body", "where"), [(b"<html>", "<html>"), (b"[]", "nothing at choices"), (b'{"choices": []}', "choices/0"), (b'{"choices": [{"message": {"content": 5}}]}', "no text at")])
def test_malformed_replies_are_told(body, where):
    with pytest.raises(RuntimeError, match=f"malformed reply: .*{where}"):
        clients.http_chat(Turns((200, {}, body)).url, "m", "k")()("s", "p", 7)


def test_requests_of_a_task_are_on_their_way_together_and_bounded(spark):
    s = Turns(GOOD, slow=0.2)
    prompts = spark.createDataFrame([(i, f"p{i % 12}") for i in range(24)], "question_id long, prompt string").coalesce(1)
    rows = answers.generate(prompts, clients.http_chat(s.url, "m", "k", parallel=4)).collect()
    assert {r["generated"] for r in rows} == {"said"} and len(rows) == 24
    assert len(s.seen) == 12 and 1 < s.most <= 4


def test_a_failed_task_and_a_replayed_batch_ask_nothing_twice(spark, tmp_path):
    s = Turns(GOOD)
    folder, broken = str(tmp_path / "ledger"), tmp_path / "broken"
    broken.write_text("")
    url = s.url
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "question_id long, prompt string").coalesce(1)

    def make():
        speak, n = clients.Service(url, "m", "k"), []

        def run(system, prompt, tokens):
            n.append(1)
            if len(n) > 5 and broken.exists():
                raise SystemExit  # not an error of a row: the worker goes
            return speak(system, prompt, tokens)

        return run

    client = clients.Generator(make, "m")
    with pytest.raises(Exception, match="(?i)exit|crash|abort"):
        answers.generate(prompts, client, ledger=folder).collect()
    assert len(s.seen) >= 5
    broken.unlink()
    for _ in range(2):
        rows = answers.generate(prompts, client, ledger=f"file://{folder}").collect()
        assert len(rows) == 20 and all(r["generated"] == "said" and r["error"] is None for r in rows)
    assert sorted(s.seen) == sorted({f"p{i}" for i in range(20)})
    answers.generate(prompts, clients.Generator(make, "other"), ledger=folder).collect()
    answers.generate(prompts, client, tokens=7, ledger=folder).collect()
    assert len(s.seen) == 60


def test_errors_and_broken_files_are_no_answers(spark, tmp_path):
    s = Turns((400, {}, b"no"), GOOD)
    prompts = spark.createDataFrame([(1, "p"), (2, None)], "question_id long, prompt string")
    client = clients.http_chat(s.url, "m", "k")
    first = answers.generate(prompts.filter("question_id = 1"), client, ledger=str(tmp_path)).collect()
    assert first[0]["error"] == "RuntimeError: HTTP 400: no"
    assert answers.generate(prompts.filter("question_id = 1"), client, ledger=str(tmp_path)).collect()[0]["generated"] == "said"
    (file,) = tmp_path.rglob("*.json")
    file.write_text("{")
    assert answers.generate(prompts.filter("question_id = 1"), client, ledger=str(tmp_path)).collect()[0]["generated"] == "said"
    assert len(s.seen) == 3


def test_generate_tells_errors_by_row(spark, service):
    prompts = spark.createDataFrame([(1, "good"), (2, "bad")], "question_id long, prompt string")
    rows = {r["question_id"]: (r["generated"], r["error"]) for r in answers.generate(prompts, clients.http_chat(service[0], "m", "k", pause=0.01)).collect()}
    assert rows == {1: ("said", None), 2: (None, "RuntimeError: HTTP 429: too much")}


def test_local():
    loads = []

    def load():
        loads.append(1)
        return lambda turns, **how: [{"generated_text": [*turns, {"role": "assistant", "content": f" {turns[1]['content']} {sorted(how.items(), key=str)} "}]}]

    speak = clients.local_chat(load)()
    assert not loads
    assert speak("s", "p", 5) == "p [('do_sample', False), ('max_new_tokens', 5), ('temperature', None), ('top_p', None)]"
    speak("s", "q", 5)
    assert loads == [1]


def test_the_session_names_the_generator(spark, service):
    assert clients.of(spark) is None
    names = {"": "http", ".url": service[0], ".model": "m", ".key": "k"}
    try:
        for n, v in names.items():
            spark.conf.set(f"spark.findery.generator{n}", v)
        assert clients.of(spark)()("s", "p", 3) == "said"
        spark.conf.set("spark.findery.generator", "local")
        with pytest.raises(RuntimeError, match="loads"):
            clients.of(spark)
        assert clients.of(spark, lambda model: lambda turns, **how: [{"generated_text": [{"content": model}]}])()("s", "p", 3) == "m"
        spark.conf.set("spark.findery.generator", "other")
        with pytest.raises(RuntimeError, match="other"):
            clients.of(spark)
    finally:
        for n in names:
            spark.conf.unset(f"spark.findery.generator{n}")
