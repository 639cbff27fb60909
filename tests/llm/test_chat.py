"""Template compiler and chat formatting."""

import hashlib
import random

import pytest

from tenderloom.llm import chat_format, template
from tenderloom.llm.template import Apply, Const, For, Name, Output, TemplateError, Text, compile_template, fold, parse

PIECES = ["<", "turn>", "/", "</turn>", "<says>", "\\", "<chat>", "x", "é", "\U0001f600", "<tur", "\n", "</chat>", "n>"]
SCHEMA = "conv_id long, turn long, role string, text string, slot string, seq string, `before` string, whole string"


def body(source):
    return "{% for message in messages %}" + source + "{% endfor %}"


def rendered(source, *messages):
    return compile_template(source).render(list(messages))


def random_messages(rnd, n):
    def text(k):
        return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, k)))

    return [(rnd.choice(["user", "assistant", text(3)]), text(6)) for _ in range(n)]


def test_constants_are_folded():
    source = "{% set a = 'x' ~ 1 + 2 %}{{ a }}-" + body("{% if not false %}{{ a | upper }}{{ message.role }}{% endif %}")
    nodes, _ = parse(source)
    assert fold(nodes, ()) == (Text("x3-"), For((Text("X3"), Output(Name("message.role")))))


@pytest.mark.parametrize(
    "expression, value",
    [
        ("1 + 2 - 4", -1), ("'a' ~ 1 ~ true ~ none", "a1true"), ("1 == true", False), ("'b' in 'abc'", True),
        ("'d' not in 'abc'", True), ("not 1 == 2", True), ("'a' if false else 'b'", "b"), ("'' or 'x' and 'y'", "y"),
        ("'é ' | trim | upper | length", 1), ("2 < 10 and 'b' > 'a'", True), ("1 < 'a'", False), (r"'a\n\'\\'", "a\n'\\"),
    ],
)
def test_expressions(expression, value):
    found = template.fold_expression(template._Expressions(expression).whole(), {}, ())
    assert found == Const(value) and type(found.value) is type(value)
    # The closure of the unfolded tree agrees.
    tree = template._Expressions(expression).whole()
    assert template.expression_closure(tree, template.Marks(()))({}) == value


def test_loop_and_names():
    source = "{% set n = 'a' %}" + body("{% if loop.first %}F{% elif loop.last %}L{% else %}{{ loop.index }}{% endif %}{{ n }}{% set n = message.role %}{{ n }};")
    assert rendered(source, ("u", ""), ("v", ""), ("w", ""))[0] == "Fau;2av;Law;"


def test_white_space_and_comments():
    assert rendered("a {#- gone -#} b{{- 'c' -}} \n" + body(" {%- if true -%} x {% endif %}"), ("u", ""))[0] == "abcx "


def test_spans_are_what_is_generated():
    text, spans = rendered(body("{{ message.role }}:{% generation %}{{ message.text }}{% endgeneration %};"), ("u", "é"), ("v", ""), ("w", "xy"))
    assert text == "u:é;v:;w:xy;" and [text[a:b] for a, b in spans] == ["é", "xy"]


@pytest.mark.parametrize(
    "source",
    [
        "no loop", body("{{ message.__class__ }}"), body("{{ x.y }}"), body("{{ x() }}"), body("{{ x[0] }}"), "{{ message.role }}" + body(""),
        body("{% for message in messages %}{% endfor %}"), body("") + body(""), body("{% if 1 %}"), body("{{ 1"), body("{{ 1 %}"),
        body("{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}"), body("{{ 'a' | eval }}"), body("{{ 1 + }}"),
        "{% if true %}" + body("") + "{% endif %}", "{% set loop = 1 %}" + body(""), "{% control 'a\\\\b' %}" + body(""), body("{{ 'a' + 1 }}"),
        "{% control '<end>' %}" + body("<en{{ message.text | escape }}"), "{% control message.role %}" + body(""),
        body("{{ " + "(" * 70 + "1" + ")" * 70 + " }}"), body("{{ 1" + " ~ 1" * 500 + " }}"), body("x" * 200_000),
    ],
)
def test_unfit_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_escapes_are_undone_whatever_the_texts():
    rnd, program = random.Random(7), compile_template(chat_format.CHAT)
    for _ in range(3000):
        messages = random_messages(rnd, rnd.randint(0, 4))
        text, spans = program.render(messages)
        assert chat_format.read_turns(text, program) == messages
        assert "".join(program.marks.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in messages if r == "assistant")


def test_escape_leaves_other_texts_alone():
    marks = template.Marks(("<turn>", "</turn>"))
    assert marks.escape("a < b <p> # x") == "a < b <p> # x"
    assert marks.escape("<turn> \\ <tu") == "\\<turn> \\\\ \\<tu"


def test_broken_output_is_refused():
    program = compile_template(chat_format.CHAT)
    for text in ("<turn>a", "<turn>a</turn>\n", "<says>", "<turn><turn>", "<turn>a<says>b<says></turn>"):
        with pytest.raises(ValueError):
            chat_format.read_turns(text, program)


def expected(rows):
    """Digests of each conversation, by sorting all rows."""
    program, out = compile_template(chat_format.CHAT), {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv),
        )
        turns = [(r, x) for _, _, r, x in mine]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(program.render(turns)[0]),
        )
    return out


def found(df):
    rows = [(r[0], tuple(r[1:])) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def odd_rows():
    rnd = random.Random(3)
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", None), (1, None, None, "first"), (1, None, "assistant", "<turn>"),
        (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (2, 0, "assistant", "other"), (3, 0, "", ""),
        (None, 0, "assistant", "nobody's"), (None, 5, "user", "\\"), (2**62, -(2**63), "user", "x"), (2**62, 2**63 - 1, "user", "y"),
        (4, 0, "assistant", "</turn>" * 300_000), (4, 1, "assistant", "z" * 1_500_000), (4, 2, "user", "end"),
    ]
    for k in range(700):
        role, text = random_messages(rnd, 1)[0]
        rows.append((5, k * 3 if k % 50 else None, role, text))
    return rows


@pytest.mark.parametrize("slot_turns", [1000, 40, 1])
def test_digests_equal_brute_force(spark, slot_turns):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(7)
    parts = chat_format.format_conversations(df, slot_turns=slot_turns)
    assert found(chat_format.digests(parts)) == expected(rows)


def test_long_conversations_are_cut_and_put_together(spark):
    rows = [(9, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(5000)] + [(8, 0, "user", "short")]
    source = body("{{ loop.index }}{% if loop.first %}F{% endif %}{% if loop.last %}L{% endif %}{{ message.text }};")
    source = "{% set k = message_count or 'B' %}{{ k }}" + source + "{{ k }}E"
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = chat_format.format_conversations(df, source, slot_turns=500).collect()
    assert len({p.slot for p in parts if p.conv_id == 9}) == 10
    texts = {c: "".join(p.text for p in sorted(parts, key=lambda p: (p.slot, p.seq)) if p.conv_id == c) for c in (8, 9)}
    program = compile_template(source)
    assert texts[9] == program.render([(r, t) for c, _, r, t in rows if c == 9])[0]
    assert texts[8] == program.render([("user", "short")])[0]


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.format_conversations(df)).collect() == []


def test_unfit_template_fails_before_any_task(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    with pytest.raises(TemplateError):
        chat_format.format_conversations(df, "{{ 1 }}")
    assert isinstance(parse(chat_format.CHAT)[0][1], (Text, Output, For, Apply, template.Set))
