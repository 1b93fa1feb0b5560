"""One rate for all tasks of an application: the driver leases slots, tasks wait for theirs."""

from __future__ import annotations

import secrets
import socket
import socketserver
import struct
import threading
import time

from pyspark.sql import SparkSession

AHEAD_S = 0.02  # of slots that a task leases at once
_known: dict[tuple[str, float], Pace] = {}


class _Slots:
    """Slots in a row, one gap apart; the next free one is never in the past."""

    def __init__(self, per_second: float):
        self.gap, self.free, self.lock = 1.0 / per_second, 0.0, threading.Lock()

    def take(self, n: int, now: float) -> float:
        """Seconds until the first of n slots."""
        with self.lock:
            start = max(now, self.free)
            self.free = start + n * self.gap
            return start - now


class _Handler(socketserver.StreamRequestHandler):
    def handle(self) -> None:
        if self.rfile.read(len(self.server.secret)) != self.server.secret:
            return
        while ask := self.rfile.read(4):
            self.wfile.write(struct.pack("<d", self.server.slots.take(struct.unpack("<I", ask)[0], time.monotonic())))


class _Server(socketserver.ThreadingTCPServer):
    daemon_threads, allow_reuse_address, request_queue_size = True, True, 1024


class Pace:
    """A rate, leased over a connection to the driver. It is sent to tasks as an address and a secret.

    A lost task wastes the slots that it had leased, a fiftieth of a second's at most or one; nothing else is lost."""

    def __init__(self, host: str, per_second: float):
        if per_second <= 0:
            raise ValueError("a rate is positive")
        self.per_second, self.secret = per_second, secrets.token_bytes(16)
        self._server = _Server(("", 0), _Handler)
        self._server.secret, self._server.slots = self.secret, _Slots(per_second)
        self.address = host, self._server.server_address[1]
        threading.Thread(target=self._server.serve_forever, daemon=True).start()

    @classmethod
    def of(cls, spark: SparkSession, per_second: float) -> Pace:
        """The application's pace of this rate: all its fetches at the rate share it."""
        at = spark.sparkContext.applicationId, float(per_second)
        if at not in _known:
            _known[at] = cls(spark.conf.get("spark.driver.host", "127.0.0.1"), per_second)
        return _known[at]

    def __getstate__(self) -> dict:
        return {"per_second": self.per_second, "secret": self.secret, "address": self.address}

    def leases(self):
        """A function that waits for the task's next slot."""
        many = max(1, int(self.per_second * AHEAD_S))
        gap = 1.0 / self.per_second
        line = socket.create_connection(self.address, timeout=60)
        line.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        line.sendall(self.secret)
        state = {"left": 0, "next": 0.0}

        def slot() -> None:
            if not state["left"]:
                line.sendall(struct.pack("<I", many))
                data = b""
                while len(data) < 8:
                    part = line.recv(8 - len(data))
                    if not part:
                        raise RuntimeError("the driver leases no more slots")
                    data += part
                state["left"], state["next"] = many, time.monotonic() + struct.unpack("<d", data)[0]
            wait = state["next"] - time.monotonic()
            if wait > 0:
                time.sleep(wait)
            state["left"] -= 1
            state["next"] += gap

        return slot

    def close(self) -> None:
        self._server.shutdown()
        self._server.server_close()
