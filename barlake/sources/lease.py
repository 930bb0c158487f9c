"""One writer at a time: a lease file in the warehouse."""

from __future__ import annotations

import json
import logging
import os
import socket
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from barlake.sources.files import create_file, names_in, path_exists, read_file, remove, rename

log = logging.getLogger(__name__)

#: How long a lease lasts that is not renewed. It is renewed three times as often while held.
SECONDS = 600


class WriterBusy(RuntimeError):
    """Another writer has the warehouse."""


_mine = threading.local()


def lease_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/_writer"


def _text(token: str, seconds: float) -> str:
    owner = f"{socket.gethostname()}:{os.getpid()}"
    return json.dumps({"token": token, "owner": owner, "until": time.time() + seconds})


def _content(spark: SparkSession, path: str) -> dict:
    """What a lease file says; nothing if it is not there or not whole."""
    try:
        return json.loads(read_file(spark, path) or "{}")
    except json.JSONDecodeError:
        return {}


def _take(spark: SparkSession, path: str, token: str, seconds: float) -> None:
    for _ in range(2):
        if create_file(spark, path, _text(token, seconds)):
            return
        other = _content(spark, path)
        if not other:
            # Being made or being given up; it is one or the other in a moment.
            time.sleep(0.2)
            continue
        if other["until"] > time.time():
            break
        # Its writer is gone. Of several that see this one moves it away.
        aside = f"{path}-{token}"
        if rename(spark, path, aside):
            moved = _content(spark, aside)
            if moved.get("token") != other["token"]:
                rename(spark, aside, path)  # someone else was quicker and has it now
                break
            log.warning("lease of %s had expired", other["owner"])
            remove(spark, aside)
    other = _content(spark, path)
    until = time.strftime("%Y-%m-%d %H:%M:%S", time.localtime(other.get("until", 0)))
    raise WriterBusy(
        f"{other.get('owner', 'another writer')} is writing, its lease {path} runs until {until}"
    )


def _renew(spark: SparkSession, path: str, token: str, seconds: float, done: threading.Event) -> None:
    while not done.wait(seconds / 3):
        if _content(spark, path).get("token") != token:
            log.error("lease %s was lost", path)
            return
        create_file(spark, path, _text(token, seconds), overwrite=True)


@contextmanager
def writer(spark: SparkSession, warehouse: str, seconds: float = SECONDS) -> Iterator[None]:
    """Hold the warehouse's lease, or raise :class:`WriterBusy` at once.

    Inside, the same thread may take it again. It is renewed while held; a writer that is lost keeps others
    out for ``seconds`` at most. The file is made only if there is none, which is as exclusive as
    the file system makes it.
    """
    held = _mine.__dict__.setdefault("held", set())
    path = lease_path(warehouse)
    if path in held:
        yield
        return
    new_place = not path_exists(spark, warehouse)
    token, done = uuid.uuid4().hex, threading.Event()
    _take(spark, path, token, seconds)
    renewing = threading.Thread(target=_renew, args=(spark, path, token, seconds, done), daemon=True)
    renewing.start()
    held.add(path)
    try:
        yield
    finally:
        held.discard(path)
        done.set()
        renewing.join()
        if _content(spark, path).get("token") == token:
            remove(spark, path)
            if new_place and not names_in(spark, warehouse):
                remove(spark, warehouse)  # nothing was stored: it is as it was
