"""Deterministic stand-ins for the model and the remote writer, for the catalogue and tests only."""

from __future__ import annotations

import json
import re

from casebook.config import SINGLE_PROMPT

_CASE = re.compile(r"Case (\d+):\n<Conversation>(.*?)</Conversation>\n\n", re.S)


def keyword_result(text: str, chat_host: str) -> dict:
    """Keyword rule used by the stand-in model (and by its SQL oracle)."""
    return {
        "category": "Escalation" if chat_host in text else ("General" if "the" in text else "Other"),
        "sub_category": "Data" if "data" in text else "Other",
        "reasoning": "keyword",
        "resolution": "Customer Education" if "?" in text else "No Action",
    }


class KeywordModel:
    """Answers every case of a prompt with ``keyword_result``. Faults by batch
    id: ``b % 7 == 0`` junk text, else ``b % 11 == 0`` one lone object, else
    ``b % 5 == 0`` one item short."""

    def __init__(self, chat_host: str, faults: bool = True):
        self.chat_host, self.faults = chat_host, faults

    def __call__(self, batch_id: str, prompt: str) -> str:
        b = int(batch_id) if str(batch_id).isdigit() else 1
        if self.faults and b % 7 == 0:
            return "Sorry, I cannot classify these."
        found = _CASE.findall(prompt)
        if not found:  # single-case prompt: answer with one object
            pre, post = SINGLE_PROMPT.split("{text}")
            return json.dumps(keyword_result(prompt[len(pre):len(prompt) - len(post)], self.chat_host))
        res = [keyword_result(t, self.chat_host) for _, t in found]
        if self.faults and b % 11 == 0:
            return json.dumps(res[0])
        if self.faults and b % 5 == 0:
            res = res[:-1]
        return json.dumps(res)


class KeyModuloFailures:
    """Deterministic stand-in for a remote API: rejects ids whose integer value
    is a multiple of ``modulus``. Used by tests and the catalogue."""

    def __init__(self, modulus: int = 17, message: str = "API update failed"):
        self.modulus, self.message = modulus, message

    def __call__(self, key: str, body: str) -> None:
        if int(key) % self.modulus == 0:
            raise RuntimeError(self.message)
