"""Elements that browsers show and that are easily taken for hidden ones."""

import pytest

from millrace.llm import html_text


@pytest.mark.parametrize(
    "page,text",
    [
        ("a<xmp>x <b>\n  &amp; y</xmp>b", "a\n\nx <b>\n  &amp; y\n\nb"),
        ("a<plaintext>b <i>c</i></plaintext> d", "a\nb <i>c</i></plaintext> d"),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>n</annotation></math>", "x=2"),
        ("<svg><title>n</title><desc>n</desc><defs><text>n</text></defs><path d='M0'/><text>label</text></svg>", "label"),
        ("<svg><text>a</text><text>b</text></svg><desc>c</desc>", "a\nb\nc"),
        ("<svg><style>n</style><text>a</text></svg><p>b", "a\n\nb"),
        ("<select><option>a<option selected>b</select>", "b"),
        ("<select><option hidden>n<option>a<option>b</select>", "a"),
        ("<select multiple><optgroup label=g><option>a</option><option>b</option></optgroup></select>", "a\nb"),
    ],
)
def test_shown(page, text):
    assert html_text.visible_text(page) == text
