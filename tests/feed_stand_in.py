"""A fetch client that logs its requests to a folder and answers from it, for tests with tasks in other processes."""

from __future__ import annotations

import os
import uuid

from threatlake.sources.fetch import FetchError, Fetched


def _file(name: str) -> str:
    return os.path.join(os.environ["FEED_STAND_IN"], name)


def clock() -> float:
    with open(_file("clock")) as f:
        return float(f.read())


class Client:
    def fetch(self, url, etag=None, last_modified=None, most=None):
        with open(_file(f"get-{uuid.uuid4().hex}"), "w") as f:
            f.write(f"{url} {etag}")
        if "broken" in url and not os.path.exists(_file("mended")):
            raise FetchError("status 500")
        if os.path.exists(_file("crash")) and "host1" in url:
            os._exit(1)
        with open(_file("version")) as f:
            now = f.read().strip()
        if etag == now:
            return Fetched(b"", url, etag, last_modified, True)
        return Fetched(f"<rss><channel><item><title>{now}</title><link>{url}/{now}</link><description>{now} of {url}</description></item></channel></rss>".encode(), url, now, None)
