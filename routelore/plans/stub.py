"""An offline labeling client for queries and tests: its answers follow from the input's number."""

from __future__ import annotations

from routelore.operators.enrich import Response


class StubClient:
    """Inputs are ``number|route|text``. Every sixth request fails, in a way that rotates."""

    def request(self, text: str) -> Response:
        number, route, _ = text.split("|", 2)
        k = int(number)
        if k % 6 == 0:
            return [Response("refused"), Response("timed_out"), Response("rate_limited"), Response("succeeded", "not json")][k // 6 % 4]
        return Response("succeeded", f'{{"name": "{route}", "arguments": {{}}}}')
