"""The vectorised line splitter of the archive source against a plain restatement."""

from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.sources.ziplines import split_lines


def plain_lines(text: str) -> list[str]:
    """Split at "\\n" only, drop one trailing "\\r", keep empty lines, last line if non-empty."""
    parts = text.split("\n")
    tail = parts.pop()
    out = [p[:-1] if p.endswith("\r") else p for p in parts]
    if tail:
        out.append(tail[:-1] if tail.endswith("\r") else tail)
    return out


def chunked(text: str, cuts: list[int]) -> list[str]:
    data = text.encode("utf-8")
    bounds = sorted({min(c, len(data)) for c in cuts} | {0, len(data)})
    out, carry = [], b""
    pieces = [data[a:b] for a, b in zip(bounds, bounds[1:])] + [b""]
    for i, piece in enumerate(pieces):
        values, carry = split_lines(carry + piece, final=i == len(pieces) - 1)
        out.extend(values.to_pylist())
    assert carry == b""
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a;\"é\x00\x0b\x85\r\n ", max_size=60), st.lists(st.integers(0, 80), max_size=6))
def test_split_lines_equals_plain_split(text, cuts):
    # cuts fall between characters of the decoded text in the reader, so keep them on
    # character boundaries here: cut the text, not its bytes
    char_cuts = [len(text[:c].encode("utf-8")) for c in cuts]
    assert chunked(text, char_cuts) == plain_lines(text)


def test_split_lines_edges():
    assert chunked("", []) == []
    assert chunked("\n", []) == [""]
    assert chunked("\r", []) == [""]
    assert chunked("a\r\r\nb", []) == ["a\r", "b"]
    assert chunked("x\n\ny\r\n", [1, 2]) == ["x", "", "y"]
    assert chunked("SÃO\r\nJOSÉ", [2]) == ["SÃO", "JOSÉ"]
