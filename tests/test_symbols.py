import pytest
from pyspark.sql import functions as F

from pagesift.functions import symbols as S


@pytest.mark.parametrize(
    "char, tex",
    [
        ("\u00a0", "\\ "), ("‖", r"\Vert "), ("Γ", r"\Gamma "), ("λ", r"\lambda "), ("ω", r"\omega "),
        ("ϕ", r"\varphi "), ("𝐀", r"\mathbf{A}"), ("𝑧", r"\mathit{z}"), ("ℎ", r"\mathit{h}"), ("𝑲", r"\bm{K}"),
        ("ℱ", r"\mathcal{F}"), ("𝒬", r"\mathcal{Q}"), ("ℂ", r"\mathbb{C}"), ("ℕ", r"\mathbb{N}"), ("𝕩", r"\mathbb{x}"),
        ("𝚰", r"\mathbf{\Iota}"), ("𝛁", r"\mathbf{\nabla}"), ("𝜕", r"\mathit{\partial}"), ("𝝏", r"\bm{\partial}"),
        ("𝛝", r"\mathbf{\vartheta}"), ("𝝇", r"\bm{\varsigma}"), ("𝝈", r"\bm{\sigma}"),
    ],
)
def test_values(char, tex):
    assert S.unicode_symbols()[char] == tex


def test_others_stay():
    table = S.unicode_symbols()
    assert not {"℃", "ℏ", "𝔄", "𝒶", "𝖠", "1", "é"} & set(table)
    assert all(len(c) == 1 for c in table)


def test_tidy(one):
    text = "$ x y } a\\ ~\\ b\\textcolor[rgb]{0.1,0,1}{\\ }\n\\[\n\tz\n\\]é"
    assert one(lambda: S.unicode_to_latex(F.col("t")), t=text) == "$x\\ y} a{\\sim}b\\ $$z$$é"


def test_entities(one):
    assert one(lambda: S.entity_to_latex(F.col("t")), t="Α≤β−1") == r"{\rm A}\le \beta -1"
    assert one(lambda: S.text_entity_to_latex(F.col("t")), t="5% \\of $a_1 ​") == r"5\% of \$a\_1\hspace{1em}"
