import pytest
from pyspark.sql import functions as F

from passagemill import schemas as S
from passagemill.functions import answers as A

ANSWERS = {
    '{"question": "a"}': "a",
    '```json\n{"question": "a"}\n```': "a",
    'Here: {"question": "a"} done': "a",
    '{"question": "line\nbreak"}': "line\nbreak",
    '{"question": "say ```x``` now"}': "say ```x``` now",
    '{"question": "cut of': "cut of",
    '{"question": ""}': "",
    '{"question": null}': None,
    '{"question": 5}': None,
    '{"other": "x"}': None,
    "no answer": None,
    "": None,
    '{"question": "a", "question": "b", "more": 1}': "b",
}


def test_validated_answers(one):
    found = one(lambda c: A.parse_structured(c, S.QUESTION), *ANSWERS)
    assert [r.question for r in found] == list(ANSWERS.values())


def test_unvalidated_question(one):
    texts = ['{"question": 5}', 'Here: {"question": "a"}', '```\n{"question": "f"}```', '{"question": ""}', "{}"]
    assert one(A.json_question, *texts) == ["5", None, "f", "", None]


def test_two_hop_needs_every_field(one):
    full = '{"question": "q", "chunk1": "a", "chunk2": "b"}'
    found = one(lambda c: A.parse_structured(c, S.TWO_HOP), full, '{"question": "q", "chunk1": "a"}')
    assert [tuple(r) for r in found] == [("q", "a", "b"), ("", "", "")]


def test_empty_output(spark):
    row = spark.range(1).select(A.empty_output(S.TWO_HOP).alias("t"), A.empty_output(S.QUESTION).alias("q")).first()
    assert tuple(row.t) == ("", "", "") and tuple(row.q) == (None,)


CONTENT = [
    ('"plain"', "text", ("plain", None)),
    ('[{"type":"reasoning_content","reasoning_content":{"text":"r"}},{"type":"text","text":"t"}]', "text", ("t", "r")),
    ('[{"type":"text","text":"t"}]', "tool_use", (None, None)),
    ('[{"type":"tool_use","input":{"question":"q"}}]', "tool_use", ('{"question":"q"}', None)),
    ('[{"type":"text"}]', "text", (None, None)),
    ('[{"type":"reasoning_content"},{"type":"text","text":"t"}]', "text", (None, None)),
    ("5", "text", (None, None)),
]


@pytest.mark.parametrize("content, style, expected", CONTENT)
def test_content_blocks(one, content, style, expected):
    assert tuple(one(lambda c: A.content_blocks(F.parse_json(c), style), content)) == expected
