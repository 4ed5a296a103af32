"""A guarded HTTPS client: conditional requests, few redirects, a byte cap, checked addresses."""

from __future__ import annotations

import ipaddress
import socket
import time
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

from ..functions.udfs import disallowed

MAX_BYTES, MAX_REDIRECTS, DELAY_SECONDS, TIMEOUT_SECONDS = 10 << 20, 3, 2.0, 15
REFERENCE_MAX_BYTES = 96 << 20
HEADERS = {"User-Agent": "threatlake", "Accept-Encoding": "gzip"}


class Blocked(ValueError):
    """The address may not be fetched."""


class TooLarge(ValueError):
    """The body exceeds the cap."""


class FetchError(RuntimeError):
    pass


@dataclass
class Fetched:
    body: bytes
    url: str
    etag: str | None
    last_modified: str | None
    not_modified: bool = False


def checked_host(url: str) -> tuple[str, int]:
    parts = urlsplit(url)
    if parts.scheme != "https" or not parts.hostname:
        raise Blocked("only https with a host")
    return parts.hostname, parts.port or 443


def resolve(host: str, port: int, lookup=socket.getaddrinfo) -> list[str]:
    """The host's addresses; one that isn't public blocks them all."""
    try:
        found = [info[4][0] for info in lookup(host, port, proto=socket.IPPROTO_TCP)]
    except OSError as e:
        raise Blocked(f"{host} doesn't resolve") from e
    if not found or any(disallowed(a) for a in found):
        raise Blocked(f"{host} resolves to an address that isn't public")
    return [str(ipaddress.ip_address(a)) for a in found]


def capped(chunks, declared: int | None, most: int) -> bytes:
    """The body, refused by its declared length or as soon as what came exceeds the cap."""
    if declared is not None and declared > most:
        raise TooLarge(f"{declared} bytes are declared")
    out = bytearray()
    for chunk in chunks:
        out += chunk
        if len(out) > most:
            raise TooLarge(f"over {most} bytes")
    return bytes(out)


class Client:
    """fetch(url); `transport(url, headers, address)` returns (status, headers, chunks) and is given in tests."""

    def __init__(self, transport=None, lookup=socket.getaddrinfo, clock=time.monotonic, sleep=time.sleep):
        self.transport, self.lookup, self.clock, self.sleep = transport or _urllib, lookup, clock, sleep
        self.last: dict[str, float] = {}

    def _wait(self, host: str) -> None:
        left = self.last.get(host, -1e9) + DELAY_SECONDS - self.clock()
        if left > 0:
            self.sleep(left)
        self.last[host] = self.clock()

    def fetch(self, url: str, etag: str | None = None, last_modified: str | None = None, most: int = MAX_BYTES) -> Fetched:
        headers = dict(HEADERS)
        if etag:
            headers["If-None-Match"] = etag
        if last_modified:
            headers["If-Modified-Since"] = last_modified
        for _ in range(MAX_REDIRECTS + 1):
            host, port = checked_host(url)
            address = resolve(host, port, self.lookup)[0]  # the connection uses the address that was checked
            self._wait(host)
            status, got, chunks = self.transport(url, headers, address)
            got = {k.lower(): v for k, v in got.items()}
            if status == 304:
                return Fetched(b"", url, etag, last_modified, True)
            if status in (301, 302, 303, 307, 308) and got.get("location"):
                url = urljoin(url, got["location"])
                continue
            if not 200 <= status < 300:
                raise FetchError(f"status {status}")
            size = got.get("content-length")
            body = capped(chunks, int(size) if size and size.isdigit() else None, most)
            if got.get("content-encoding") == "gzip":
                import zlib

                inflate = zlib.decompressobj(31)
                body = inflate.decompress(body, most + 1)
                if len(body) > most:
                    raise TooLarge(f"over {most} bytes")
            return Fetched(body, url, got.get("etag"), got.get("last-modified"))
        raise FetchError("too many redirects")


def _urllib(url: str, headers: dict, address: str):
    import http.client
    import ssl

    parts = urlsplit(url)

    class Pinned(http.client.HTTPSConnection):
        def connect(self):
            raw = socket.create_connection((address, self.port), self.timeout)
            self.sock = ssl.create_default_context().wrap_socket(raw, server_hostname=parts.hostname)

    connection = Pinned(parts.hostname, parts.port or 443, timeout=TIMEOUT_SECONDS)
    connection.request("GET", (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), headers=headers)
    answer = connection.getresponse()
    return answer.status, dict(answer.getheaders()), iter(lambda: answer.read(1 << 16), b"")


__all__ = ["Blocked", "Client", "FetchError", "Fetched", "TooLarge", "capped", "checked_host", "resolve"]
