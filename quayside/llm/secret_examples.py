"""Labelled findings: planted values whose label is known from what was planted, not from how it looks.

The same forms of value stand on both sides: a run of hex digits is a key in one context and a checksum in another,
and what is assigned to a password may be one, a placeholder or a reference. Contexts marked as held out
are never learned from.
"""

from __future__ import annotations

import random
import string
from collections.abc import Callable, Iterator

HEX, ALNUM, UPPER = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_uppercase + string.digits
SYLLABLES = "an be co der el fi ga ho in ja ka le mi no or pe qua re si to un va wi xa yo zu tion ment schaft heit ling ique ado"


def _of(alphabet: str, *sizes: int) -> Callable[[random.Random], str]:
    return lambda draw: "".join(draw.choice(alphabet) for _ in range(draw.choice(sizes)))


def _after(start: str, rest: Callable[[random.Random], str]) -> Callable[[random.Random], str]:
    return lambda draw: start + rest(draw)


def _word(draw: random.Random, least: int = 1, most: int = 4) -> str:
    return "".join(draw.choice(SYLLABLES.split()) for _ in range(draw.randint(least, most)))


def _password(draw: random.Random) -> str:
    parts = [_word(draw, 1, 2).capitalize(), str(draw.randint(0, 9999)), draw.choice("!#%&*.?@$"), _word(draw, 1, 2)]
    draw.shuffle(parts)
    out = "".join(parts)
    return out.replace("o", draw.choice("o0")).replace("e", draw.choice("e3"))


def _random_password(draw: random.Random) -> str:
    return "".join(draw.choice(ALNUM + "!#%*.-_~") for _ in range(draw.randint(9, 20)))


def _uuid(draw: random.Random) -> str:
    return "-".join(_of(HEX, n)(draw) for n in (8, 4, 4, 4, 12))


def _joined(mark: str) -> Callable[[random.Random], str]:
    return lambda draw: mark.join(_word(draw, 1, 2) for _ in range(draw.randint(3, 6)))


def _camel(draw: random.Random) -> str:
    return _word(draw) + "".join(_word(draw, 1, 2).capitalize() for _ in range(draw.randint(2, 5)))


def _placeholder(draw: random.Random) -> str:
    name = draw.choice(["token", "api-key", "password", "secret"])
    return draw.choice(["changeme", "xxxxxxxxxxxxxxxx", f"your-{name}-here", f"<{name}>", f"example_{name}", "********", f"dummy{draw.randint(1, 99)}", f"test-{name}-{draw.randint(1, 9)}", "REDACTED"])


def _reference(draw: random.Random) -> str:
    name = _joined("_")(draw).upper()
    return draw.choice([f"${{{name}}}", f"$({name})", f"os.environ[{name}]", f"{{{{ {name} }}}}".replace(" ", ""), f"process.env.{name}", f"settings.{name.lower()}", f"%{name}%"])


def _name(draw: random.Random) -> str:
    return draw.choice(["bert-base-uncased", "basic", "oauth2", "required", "none", "true", "disabled", "enabled", "RS256", "sha256", "public", _camel(draw), _joined("-")(draw), _joined(".")(draw)])


def _plain_words(draw: random.Random) -> str:
    return _word(draw, 5, 9)


# Kinds of values. 1: secrets.
SECRETS = {
    "hex key": _of(HEX, 32, 40, 64),
    "upper hex key": lambda draw: _of(HEX, 32, 40)(draw).upper(),
    "cloud key id": _after("AKIA", _of(UPPER, 16)),
    "forge token": lambda draw: draw.choice(["ghp_", "gho_", "ghs_", "glpat-"]) + _of(ALNUM, 36)(draw),
    "payment key": lambda draw: draw.choice(["sk_live_", "rk_live_"]) + _of(ALNUM, 24, 32)(draw),
    "chat token": lambda draw: draw.choice(["xoxb-", "xoxp-"]) + "-".join(_of(string.digits, 11)(draw) for _ in range(2)) + "-" + _of(ALNUM, 24)(draw),
    "signed token": lambda draw: "eyJ" + _of(ALNUM, 30)(draw) + "." + _of(ALNUM + "_-", 60)(draw) + "." + _of(ALNUM + "_-", 43)(draw),
    "base64 key": lambda draw: _of(ALNUM + "+/", 43)(draw) + "=",
    "mixed key": _of(ALNUM, 20, 24, 32, 48),
    "password": _password,
    "random password": _random_password,
}
# 0: what looks like one.
OTHERS = {
    "commit": _of(HEX, 40),
    "checksum": _of(HEX, 32, 64, 128),
    "uuid": _uuid,
    "long word": _plain_words,
    "constant": lambda draw: _joined("_")(draw).upper(),
    "identifier": _camel,
    "snake name": _joined("_"),
    "slug": lambda draw: _joined("-")(draw) + draw.choice(["", f"-{draw.randint(1, 9999)}"]),
    "path": lambda draw: _joined("/")(draw),
    "number": _of(string.digits, 16, 18, 20),
    "rule": lambda draw: draw.choice("=-_+") * draw.randint(16, 60),
    "image data": lambda draw: "iVBORw0KGgo" + _of(ALNUM + "+/", 80, 200)(draw) + "==",
    "placeholder": _placeholder,
    "reference": _reference,
    "setting": _name,
    "letters": lambda draw: "".join(draw.choice("ACGT") for _ in range(draw.randint(20, 60))),
    "capitals": lambda draw: _plain_words(draw).upper(),
    "title word": lambda draw: _plain_words(draw).capitalize(),
}

# Contexts of a kind: a template, and whether it is held out. `{v}` is the value, `{w}` a word.
_KEPT = [
    ('{w} token = "{v}" {w}', False), ("{w}\nAPI_KEY={v}\n{w}", False), ("api_key: '{v}'\n", False), ('"secret": "{v}", "{w}": 1', False),
    ("{w} https://{w}:{v}@{w}.net/{w} {w}", False), ("{w} https://{w}.com/{w}?access_token={v}&{w}=2", False), ("Authorization: Bearer {v}\n", False),
    ("export {w}_PASSWORD='{v}'", False), ("postgres://{w}:{v}@db/{w}", False), ("{w} client_secret := `{v}`", True), ("passwd: {v}\n{w}", True),
    ('{w}.auth_token => "{v}",', True), ("curl {w}.org/?{w}=1&apikey={v} {w}", True), ("{w}@{w}.io private_key='{v}'", True), ("TOKEN = \"{v}\"!! {w}", False),
]
CONTEXTS = {
    "commit": [("commit {v}\nAuthor: {w}", False), ("{w} at revision {v}, {w}", False), ("merged {v} into {w}", True), ("rev: {v}\n", False), ("git checkout {v} {w}", True)],
    "checksum": [("sha256: {v}  {w}.tar", False), ("{v}  {w}.zip\n", False), ("md5sum={v} {w}", False), ("integrity='{v}'", True), ("{w} digest {v} {w}", True), ('"hash": "{v}"', False)],
    "uuid": [("id={v} {w}", False), ("{w} https://{w}.com/{w}/{v}", False), ('"uuid": "{v}"', False), ("{w} {v} {w}", True), ("https://{w}.net/?session={v}&{w}=1", True)],
    "long word": [("{w} {v} {w} {w}.", False), ("{w}, {v}. {w}", False), ("({v}) {w} {w}", True), ("\n{v}\n{w}", True), ("{w} {w} {v}", False)],
    "capitals": [("{w} {v} {w} {w}.", False), ("{w}!! {v}!! {w}", False), ("\n{v}\n{w}", True)],
    "title word": [("{w}. {v} {w} {w}.", False), ("{w}.\n{v}, {w}", False), ("{w}: {v} {w}", True)],
    "constant": [("#define {v} {w}", False), ("if ({v} > 3)", False), ("{w} = {v};", True)],
    "identifier": [("def {v}(self):", False), ("{w}.{v}({w})", False), ("new {v}()", True)],
    "snake name": [("self.{v} = {w}", False), ("{v}({w}, {w})", False), ("import {v}", True)],
    "slug": [("https://{w}.com/{w}/{v}", False), ("https://{w}.com/?utm_source={v}&{w}=1", False), ("class=\"{v} {w}\"", True), ("{w} www.{w}.org/?q={v}", True)],
    "path": [("/usr/{v}/{w}.txt", False), ("see {v} {w}", False), ("https://{w}.io/{v}", True)],
    "number": [("{w} {v} {w}", False), ("order: {v}\n", False), ("{w} no {v}.", True), ("https://{w}.com/?id={v}", True), ("{w}: {v}, {w}", False)],
    "rule": [("{w}\n{v}\n{w}", False), ("{v} {w} {w}", False), ("\n# {v}\n", True)],
    "image data": [('src="data:image/png;base64,{v}"', False), ("url(data:image/png;base64,{v})", True)],
    "placeholder": [('token = "{v}"', False), ("API_KEY={v}\n", False), ("https://{w}:{v}@{w}.net/", False), ("password: {v}\n", True), ("{w} https://{w}.com/?api_key={v}&{w}=1", True)],
    "reference": [('token = "{v}"', False), ("API_KEY={v}\n", False), ("password: {v}\n", True), ("Authorization: Bearer {v}\n", True)],
    "setting": [("token_type = \"{v}\"", False), ("auth: {v}\n", False), ("private={v} {w}", False), ("tokenizer={v}", True), ("auth_method: '{v}'", True)],
    "letters": [("{w} {v} {w}", False), (">seq {w}\n{v}\n", True)],
}
PATHS = ("src/{w}.py", "config/{w}.yml", ".env", "docs/{w}.md", "{w}/{w}.js", "data/{w}.json", None, "notes/{w}.txt", None, "web", "src7", None)


def examples(per_context: int = 30, seed: int = 11) -> Iterator[tuple[int, str, str | None, int, int, int, str, bool]]:
    """(id, text, source, start, length, label, kind, held out): planted findings, `per_context` in each context.

    start and length are in characters. The same arguments give the same examples.
    """
    draw, number = random.Random(seed), 0
    for label, kinds in ((1, SECRETS), (0, OTHERS)):
        for kind, value in kinds.items():
            contexts = _KEPT if label else CONTEXTS[kind]
            for template, aside in contexts:
                for _ in range(per_context if not label else max(1, per_context // 3)):
                    planted, (head, tail) = value(draw), template.split("{v}")
                    head = _filled(head, draw)
                    text, start = head + planted + _filled(tail, draw), len(head)
                    before = " ".join(_word(draw) for _ in range(draw.randint(0, 8)))
                    text, start = (f"{before} {text}", start + len(before) + 1) if before else (text, start)
                    path = draw.choice(PATHS)
                    yield number, text, path and _filled(path, draw), start, len(planted), label, kind, aside
                    number += 1


def _filled(part: str, draw: random.Random) -> str:
    out = part.split("{w}")
    return "".join(piece + (_word(draw) if i < len(out) - 1 else "") for i, piece in enumerate(out))
