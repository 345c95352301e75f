"""Deterministic stand-in for a text-generation model (tests and driver queries).

Both replies are functions of the *whole* chunk (its md5 and length), so the
generation program has a SQL oracle:

Question prompt -> "What does <md5> cover?,Which points fill <length> characters?"
                   plus ",Why the commas?" when the chunk has a comma, plus a
                   trailing "," (a blank question) when the length is a multiple of 7
Answer prompt   -> "<reference><md5></reference><answer><question></answer>"
"""

from __future__ import annotations

import hashlib

from sftprep.functions.prompts import ANSWER_PROMPT, QUESTION_PROMPT

_Q_HEAD = QUESTION_PROMPT.split("{context}")[0]
_Q_TAIL = "\n</context>\nGenerate "
_A_HEAD = ANSWER_PROMPT.split("{context}")[0]
_A_MID = "\n</context>\n<question>\n"
_A_TAIL = "\n</question>\n"


def _md5(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def question_reply(context: str) -> str:
    reply = f"What does {_md5(context)} cover?,Which points fill {len(context)} characters?"
    if "," in context:
        reply += ",Why the commas?"
    if len(context) % 7 == 0:
        reply += ","
    return reply


def answer_reply(context: str, question: str) -> str:
    return f"<reference>{_md5(context)}</reference><answer>{question}</answer>"


def reply(messages: list[dict]) -> str:
    prompt = messages[-1]["content"]
    if prompt.startswith(_Q_HEAD):
        return question_reply(prompt[len(_Q_HEAD) : prompt.rindex(_Q_TAIL)])
    if prompt.startswith(_A_HEAD):
        body = prompt[len(_A_HEAD) : prompt.rindex(_A_TAIL)]
        context, question = body.rsplit(_A_MID, 1)
        return answer_reply(context, question)
    return ""


class StubClient:
    def __init__(self):
        self.calls = 0

    def __call__(self, batch: list[list[dict]], **_opts) -> list[str]:
        self.calls += len(batch)
        return [reply(m) for m in batch]


def make_client() -> StubClient:
    return StubClient()
