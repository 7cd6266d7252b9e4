"""Formula markup as LaTeX.

Most elements are a layout: a pattern over the LaTeX of their named children. The few whose shape depends on
properties or on more than one child have a function. Elements that nobody knows give what is inside them.
"""

from __future__ import annotations

import re
import unicodedata
import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"

# Signs and their LaTeX, sign and command in turn.
_SIGNS = r"""
× \times ÷ \div ± \pm ∓ \mp · \cdot ⋅ \cdot ≤ \leq ≥ \geq ≠ \neq ≈ \approx ≡ \equiv ∝ \propto ∞ \infty
∈ \in ∉ \notin ⊂ \subset ⊃ \supset ⊆ \subseteq ⊇ \supseteq ∪ \cup ∩ \cap ∅ \emptyset ∀ \forall ∃ \exists
→ \rightarrow ← \leftarrow ↔ \leftrightarrow ⇒ \Rightarrow ⇐ \Leftarrow ⇔ \Leftrightarrow
∵ \because ∴ \therefore ∠ \angle ⊥ \perp ∥ \parallel △ \triangle ∂ \partial ∇ \nabla
∑ \sum ∏ \prod ∫ \int ∮ \oint … \ldots ⋯ \cdots ~ \sim ε \varepsilon φ \varphi ϕ \phi
"""
# Signs that take no space behind them.
_TIGHT = {"°": r"^{\circ}", "′": "'", "″": "''", "√": r"\sqrt", "−": "-", "–": "-", "—": "-", "%": r"\%", "&": r"\&", "#": r"\#", "$": r"\$", "{": r"\{", "}": r"\}"}
# Greek letters that have a command of their own name, small and capital.
_SMALL = "alpha beta gamma delta zeta eta theta iota kappa lamda mu nu xi pi rho sigma tau upsilon chi psi omega"
_CAPITAL = "Gamma Delta Theta Lamda Xi Pi Sigma Phi Psi Omega"
# Accents, by what stands above the base.
ACCENTS = {"̂": "hat", "^": "hat", "̌": "check", "̃": "tilde", "́": "acute", "̀": "grave", "̇": "dot", "̈": "ddot", "⃛": "dddot", "̄": "bar", "̅": "overline", "⃗": "vec", "⃖": "overleftarrow", "⃡": "overleftrightarrow", "̆": "breve", "⃑": "overrightarrow"}
NARY = {"∑": "sum", "∏": "prod", "∐": "coprod", "∫": "int", "∬": "iint", "∭": "iiint", "∮": "oint", "⋃": "bigcup", "⋂": "bigcap", "⋁": "bigvee", "⋀": "bigwedge"}
GROUPS = {"⏟": "underbrace", "⏞": "overbrace", "⏝": "underbrace", "⏜": "overbrace", "←": "underleftarrow", "→": "underrightarrow"}
BRACKETS = {"{": r"\{", "}": r"\}", "‖": r"\|", "⟨": r"\langle", "⟩": r"\rangle", "〈": r"\langle", "〉": r"\rangle", "⌈": r"\lceil", "⌉": r"\rceil", "⌊": r"\lfloor", "⌋": r"\rfloor", "": ".", " ": "."}
FUNCTIONS = frozenset("sin cos tan cot sec csc arcsin arccos arctan sinh cosh tanh log ln lg exp lim max min det gcd sup inf arg deg dim ker".split())


def _greek(kind: str, names: str) -> dict[str, str]:
    """Letters by their Unicode names; LaTeX writes lambda with a b."""
    return {unicodedata.lookup(f"GREEK {kind} LETTER {n.upper()}"): f"\\{n.replace('amda', 'ambda')} " for n in names.split()}


_pairs = _SIGNS.split()
SIGNS = {sign: f"{command} " for sign, command in zip(_pairs[::2], _pairs[1::2])} | _greek("SMALL", _SMALL) | _greek("CAPITAL", _CAPITAL) | _TIGHT
_PIECE = re.compile(r"([　-〿一-鿿＀-￯]+)|(.)", re.S)


def escaped(text: str, upright: bool = False) -> str:
    """Text of a run: signs as commands, styled letters as plain ones, wide characters as text; ``upright`` keeps letters."""

    def one(m: re.Match) -> str:
        if m[1]:
            return rf"\text{{{m[1]}}}"
        form = unicodedata.normalize("NFKC", m[2])
        c = form if "\U0001d400" <= m[2] <= "\U0001d7ff" and form.isascii() else m[2]
        return c if upright and c.isalpha() else SIGNS.get(c, c)

    out = _PIECE.sub(one, text)
    return rf"\mathrm{{{out}}}" if upright and re.fullmatch("[A-Za-z]+", out) else out


class Node:
    """An element with short ways to its children and properties."""

    def __init__(self, element: ET.Element):
        self.element, self.name = element, element.tag.removeprefix(M)

    def __getitem__(self, child: str) -> str:
        found = self.element.find(M + child)
        return "" if found is None else inside(found)

    def all(self, child: str) -> list[str]:
        return [inside(x) for x in self.element.findall(M + child)]

    def given(self, name: str, default: str = "") -> str:
        found = self.element.find(f"{M}{self.name}Pr/{M}{name}")
        return default if found is None else found.get(M + "val", default)

    def on(self, name: str) -> bool:
        return self.given(name) in ("1", "on", "true")


def inside(element: ET.Element) -> str:
    return "".join(latex(x) for x in element if isinstance(x.tag, str) and x.tag.startswith(M))


def _fraction(n: Node) -> str:
    shapes = {"lin": "{{{0}}}/{{{1}}}", "skw": "{{}}^{{{0}}}/_{{{1}}}", "noBar": r"\binom{{{0}}}{{{1}}}"}
    return shapes.get(n.given("type", "bar"), r"\frac{{{0}}}{{{1}}}").format(n["num"], n["den"])


def _root(n: Node) -> str:
    degree = "" if n.on("degHide") else n["deg"]
    return rf"\sqrt[{degree}]{{{n['e']}}}" if degree else rf"\sqrt{{{n['e']}}}"


def _delimited(n: Node) -> str:
    begin, end, parts = n.given("begChr", "("), n.given("endChr", ")"), n.all("e")
    if begin == "{" and end.strip() == "" and len(parts) == 1 and n.element.find(f"{M}e/{M}eqArr") is not None:
        return parts[0].replace("{aligned}", "{cases}")
    between = escaped(n.given("sepChr", "|")) or "|"
    return rf"\left{BRACKETS.get(begin, begin)} {between.join(parts)} \right{BRACKETS.get(end, end)}"


def _nary(n: Node) -> str:
    sign = n.given("chr", "∫")
    out = f"\\{NARY[sign]}" if sign in NARY else SIGNS.get(sign, sign).strip()
    for child, mark, hidden in (("sub", "_", "subHide"), ("sup", "^", "supHide")):
        if n[child] and not n.on(hidden):
            out += f"{mark}{{{n[child]}}}"
    return f"{out} {n['e']}"


def _function(n: Node) -> str:
    name = n["fName"].strip()
    known = re.fullmatch(r"(?:\\mathrm\{([a-z]+)\}|([a-z]+))(.*)", name, re.S)
    if known and (known[1] or known[2]) in FUNCTIONS:
        name = f"\\{known[1] or known[2]}{known[3]}"
    return f"{name} {n['e']}"


def _equations(n: Node) -> str:
    """Lines one below the other; a condition behind the first comma is aligned."""
    lines = []
    for line in map(str.strip, n.all("e")):
        comma = re.match(r"([^&,]+?)\s*,\s*([^&]*)$", line, re.S) or re.match(r"([^&，]+?)\s*，\s*([^&]*)$", line, re.S)
        lines.append(f"{comma[1]}, & {comma[2]}" if comma else line)
    return r"\begin{aligned} " + r" \\ ".join(lines) + r" \end{aligned}"


def _run(n: Node) -> str:
    style = n.element.find(f"{M}rPr/{M}sty")
    return escaped("".join(t.text or "" for t in n.element.iter(M + "t")), style is not None and style.get(M + "val") == "p")


#: Elements whose LaTeX is a pattern over their children.
LAYOUTS = {"sSub": "{e}_{{{sub}}}", "sSup": "{e}^{{{sup}}}", "sSubSup": "{e}_{{{sub}}}^{{{sup}}}", "sPre": "{{}}_{{{sub}}}^{{{sup}}}{e}", "limLow": "{e}_{{{lim}}}", "limUpp": "{e}^{{{lim}}}", "box": "{e}", "borderBox": r"\boxed{{{e}}}", "phant": r"\phantom{{{e}}}"}
SHAPES: dict[str, Callable[[Node], str]] = {
    "r": _run,
    "t": lambda n: escaped(n.element.text or ""),
    "f": _fraction,
    "rad": _root,
    "d": _delimited,
    "nary": _nary,
    "func": _function,
    "eqArr": _equations,
    "acc": lambda n: rf"\{ACCENTS.get(n.given('chr', chr(0x302)), 'hat')}{{{n['e']}}}",
    "bar": lambda n: rf"\{'overline' if n.given('pos', 'bot') == 'top' else 'underline'}{{{n['e']}}}",
    "groupChr": lambda n: rf"\{GROUPS.get(n.given('chr', '⏟'), 'underbrace')}{{{n['e']}}}",
    "lim": lambda n: inside(n.element).replace(r"\rightarrow ", r"\to "),
    "m": lambda n: r"\begin{matrix} " + r" \\ ".join(" & ".join(inside(e) for e in row.findall(M + "e")) for row in n.element.findall(M + "mr")) + r" \end{matrix}",
    "oMathPara": lambda n: r" \\ ".join(n.all("oMath")),
}


class _Children(dict):
    def __init__(self, node: Node):
        super().__init__()
        self.node = node

    def __missing__(self, name: str) -> str:
        return latex(x) if name == "lim" and (x := self.node.element.find(M + name)) is not None else self.node[name]


def latex(element: ET.Element) -> str:
    """An element as LaTeX, spaces as they come."""
    node = Node(element)
    if node.name in LAYOUTS:
        return LAYOUTS[node.name].format_map(_Children(node))
    if node.name in SHAPES:
        return SHAPES[node.name](node)
    return "" if node.name.endswith("Pr") else inside(element)


def formula(element: ET.Element) -> str:
    """A whole formula: one space at most, none before scripts and braces."""
    return re.sub(r"\s+([_^{}])", r"\1", re.sub(r"[ \t]+", " ", latex(element)).strip())


def omml_latex(source: str) -> str:
    return formula(ET.fromstring(source))


@F.pandas_udf(T.StringType())
def omml_to_latex(source: pd.Series) -> pd.Series:
    """Formula markup as LaTeX; null where it cannot be read."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else omml_latex(x)
        except ET.ParseError:
            return None

    return source.map(one)
