"""Template residue and error-page text.

Message templates are mined over the whole corpus. Messages (sentences of lines) descend a prefix tree of fixed depth: number
of tokens, then the first three signal words with their places. In a leaf, tokens that a good share of its messages has at their
place are the template's constants, others are wildcards; so a template follows from counts over all rows, in whatever
order and tasks they come. Words that the patterns of the verdict read are never wildcards. Each template is judged once,
and its verdict goes back to its messages and from these to the documents in joins. Unresolved slots are looked for
separately, in every message that isn't about such things.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A token is a constant of its leaf's templates if this share of the leaf's messages has it at its place; so a place has 1 / CONSTANT of them at most.
CONSTANT = 0.1
#: Signal words of a path in the tree.
DEPTH = 3
#: Words that a sentence without any function word has at least if it is filler.
BABBLE = 8
#: A wildcard; a word to the patterns, but none that they know.
WILD = "__"

# Words that messages of sites, fillers and forms are made of, lower case and without accents.
SIGNALS = frozenset(
    """
    acceso access active activar activarlo activas aqui asdf baja bla blocked bloqueados bloqueado busca caducado cambio
    captcha cargarse cargando codigo conexion continuar controlada cookies cuenta definir demasiadas demasiado denegado
    denied depends desactivado descargas description descripcion did direccion disponible dio dolor enable encontrada encontrado
    encontramos encontro error esperando excepcion exception existe expirado expired fallida failed found forbidden gateway guiones
    habilitar habilite http inexistente iniciar iniciarse inicie interno internal invalid ipsum javascript limite loaded
    login longer lorem mal mantencion mantenimiento maintenance maqueta muestra navegador necesita need needs not open
    pagina parrafo permiso permite permission placeholder prueba publicar rechazada rechazo reemplazado relleno requests requiere
    required requires respuesta responder answer retirado robot sample scripting scripts script server servicio servidor sesion session sign
    solicitudes status stopped superado text texto timed timeout trouble unavailable unhandled upstream usted vacia va
    visor wrong
    """.split()
)

# What is said of a page or file that isn't there, lower case and without accents.
_ERROR = re.compile(
    r"no pudo (?:cargarse|abrirse|iniciarse|completarse)|could not (?:be loaded|open|be found|load)|no (?:esta|se encuentra) disponible (?:por|en este|temporal)|"
    r"no existe o cambio|tardo demasiado|did not answer|timed? ?out\b|(?:devolvio una |)respuesta vacia|rechazo la conexion|conexion rechazada|"
    r"esta en (?:mantencion|mantenimiento) program|no disponible por (?:mantencion|mantenimiento)|requiere iniciar sesion|debe iniciar sesion|se dio de baja\.?\W*$|"
    r"is no longer (?:here|available)|was not found|\bpage not found|pagina no encontrada|no encontramos (?:la|lo|el)|no se encontro la pagina|"
    r"(?:enlace|link) (?:ha|has) (?:expirado|expired)|archivo fue retirado|(?:su|your) (?:sesion ha caducado|session has expired)|no tiene permiso para|"
    r"permission denied|access denied|acceso denegado|demasiadas solicitudes|too many requests|limite de descargas|excepcion no controlada|"
    r"unhandled exception|gateway (?:trouble|timeout)|bad gateway|consulta fallida|algo salio mal|something went wrong|internal server error|"
    r"error interno del servidor|service unavailable|servicio no disponible|no es un robot|not a robot|^\W*(?:error|status|http)\W*\d{3}\W*$|^\W*\d{3}\W+(?:error|not found|forbidden)|"
    r"please (?:log|sign) in|inicie sesion para (?:ver|continuar|acceder)"
)
_THING = r"(?:javascript|scripts?|scripting|cookies|guiones)"


def _gap(n: int) -> str:
    """Up to n words."""
    return rf"(?:\W+\w+){{0,{n}}}?\W+"


_SCRIPT = re.compile(
    rf"(?:habilit\w+|activ[ea]r?\w*|enable|turn on|needs?|necesita|requires?|requiere|depends on|allow|permita)\b{_gap(5)}{_THING}|"
    rf"{_THING}\b{_gap(4)}(?:desactivad|bloquead|disabled|blocked|required|is off)|^\W*(?:div\W+)?sin\b{_gap(4)}{_THING}\b{_gap(4)}no es posible|"
    rf"esperando a\b{_gap(4)}{_THING}|navegador no permite ejecutar|depends on el visor|"
    rf"(?:habilit\w+|enable|sin|esperando a|needs?|necesita|depends on)\b{_gap(3)}visor con {_THING}"
)
_FILLER = re.compile(
    r"lorem ipsum|texto de relleno para|\bsample text (?:goes|here)|parrafo de (?:ejemplo|muestra|prueba) que sera|^\W*(?:\S+ ){0,8}?aqui va (?:la|el|un|una) (?:descripcion|texto|titulo|contenido)|"
    r"contenido de (?:muestra|prueba|relleno)\b|\b(?:bla ){2,}bla\b|\basdf\b.*\basdf\b|\b(?:texto ){2,}texto\b|(?:prueba \d+\W*){2,}|placeholder text|texto de prueba\W*$"
)
_JSON = re.compile(r'^\W*\{\s*"(?:status|error|code|message)"\s*:.*"(?:message|error|status|detail)"', re.I)

# Signs that a message is spoken of, shown or used in class.
_ABOUT = re.compile(
    r"\btraduzca|\btranslate\b|\bse (?:explica|muestra|ensena|lee|conversa|comenta|proyecta|escribe|observa|discute|analiza|copia)\b|\bensena a\b|\bcomenta que\b|"
    r"\baparece el mensaje\b|\bla frase\b|\bel aviso\b|\bel mensaje\b|\bcomo ejemplo\b|\bpor ejemplo\b|\bfor example\b|\ben programacion\b|laboratorio de programacion|\bplantilla usa\b|"
    r"\b(?:los|las) (?:estudiantes|alumn[oa]s)\b|\blearners\b|\bthe class\b|\bcada grupo\b|\bel grupo\b|\bdiscuten?\b|\balgunos sitios\b|"
    r"nombre de variable|\breemplaza\b|\bsignifica\b|\bindican? (?:que|donde)\b|\bavisa al?\b|\bthe (?:message|notice|phrase)\b|\bsea el conjunto\b|\bintervalo\b"
)
#: An instruction whose object follows to the end of the line.
_INTRODUCES = re.compile(r"\b(?:traduzca|translate|copie|lea|explique|comente|corrija)\b[^:]{0,60}:", re.I)
_QUOTED = re.compile(r"«[^»]*»?|“[^”]*”?|\"[^\"]*\"?")

_FUNCTION = frozenset(
    "a al con de del el en es la las los o para por que se su sus un una y e u como más sin no lo the of and to in is are with for each their on an at by from before can uma um os as do da em não com".split()
)
_ACCENTS = list(zip("áéíóúüñàâêôõãç", "aeiouunaaeooac"))
_APART = bytes(c if chr(c).isalpha() and c < 128 else 32 for c in range(256))
_SIGNALS = frozenset(w.encode() for w in SIGNALS)
_FUNCTIONS = frozenset(w.encode() for w in _FUNCTION)
_END = re.compile(r"(?<=[.?!…])\s+(?=\S)")
_LATIN = re.compile(r"[A-Z]?[a-z]+")

# Slots that nothing else is written like. Then those that count as the value of a label, with or without a name.
_SLOT = re.compile(
    r"\{\{\s*[^\W\d][\w .]*\}\}|\{%\s*[^\W\d][\w .]*%\}|<%=?\s*[^\W\d][\w .]*%>|\[\[\s*[^\W\d]\w*\s*\]\]|\$\{\s*[^\W\d]\w*\s*\}|@@[^\W\d]\w*@@|&lt;[^\W\d]\w*&gt;|<<[^\W\d][^<>\n]*>>|"
    r"\{[^\W\d]\w+\}|(?<![\w%])%[^\W\d_][^\W\d]{2,}%(?![\w%])|(?<![\w$])\$[^\W\d_][^\W\d]{2,}\$(?![\w$])|\[(?:PENDIENTE|TODO|FALTA|INSERT\w*|COMPLETAR)\b[^\]\n]*\]|\[(?:Inserte|Insert|Escriba|Complete|Agregue)\b[^\]\n]*\]|"
    r"\b[Hh]aga clic (?:aquí )?para (?:agregar|escribir|insertar)|\b[Cc]lick (?:here )?to (?:add|enter|insert)|\bTODO:|\((?:completar|rellenar|agregar|por definir)\b[^)\n]*\)|\bX{4,}\b|\bNOMBRE_DEL?_\w+|\bPOR DEFINIR\b|\[falta\]"
)
_NUMBERED = re.compile(r"\{\d+\}")
_VALUE = re.compile(r"(?:^|[^\w])([^\W\d][^:\n]{0,40}?):\s*(?:«\s*([\w ]+?)\s*»|<\s*([\w ]+?)\s*>|\[\s*([\w ]+?)\s*\]|#([\w ]+?)#|__([^\W_][\w ]*?)__|(null|undefined|NaN|None|nil))\s*(?=$|\s)")


def _plain(s: str) -> str:
    s = s.lower()
    if not s.isascii():
        for a, b in _ACCENTS:
            s = s.replace(a, b)
    return s


def messages(line: str) -> list[str]:
    """Sentences of a line; one that opens a quotation goes on to its end."""
    parts = _END.split(line)
    if len(parts) == 1 or not ("«" in line or '"' in line or "“" in line):
        return parts
    out: list[str] = []
    for p in parts:
        if out and (out[-1].count("«") > out[-1].count("»") or out[-1].count("“") > out[-1].count("”") or out[-1].count('"') % 2):
            out[-1] += " " + p
        else:
            out.append(p)
    return out


def verdict(template: str) -> str | None:
    """error, script, filler or None, for the words of a template in lower case without accents."""
    if _JSON.search(template) and ("mensaje" in template or "message" in template):
        return "error"
    open_ = _QUOTED.sub(" ", template)
    if _ABOUT.search(open_):
        return None
    if _ERROR.search(open_):
        return "error"
    if _SCRIPT.search(open_):
        return "script"
    return "filler" if _FILLER.search(open_) else None


def babble(tokens: list[str]) -> bool:
    """A sentence of BABBLE words or more in plain Latin letters without one function word."""
    words = [t.rstrip(".,;") for t in tokens]
    return len(words) >= BABBLE and all(_LATIN.fullmatch(w) for w in words) and sum(w[:1].isupper() for w in words) <= 1 and not any(w.lower() in _FUNCTION for w in words)


def slot(message: str) -> bool:
    """A placeholder stands in the message where a value belongs."""
    about = _ABOUT.search(_plain(message))
    if about:
        return False
    if _SLOT.search(message) or len(set(_NUMBERED.findall(message))) > 1:
        return True
    for m in _VALUE.finditer(message):
        if m[7]:
            return True
        name = next(g for g in m.groups()[1:6] if g)
        label, name = (_plain(x).replace("_", " ").strip() for x in (m[1], name))
        if label.endswith(name) or name.endswith(label.split()[-1]):
            return True
    return False


# Words and beginnings of words that the patterns of the verdict read.
_READ = frozenset(w for p in (_ERROR, _SCRIPT, _FILLER, _JSON, _ABOUT) for w in re.findall("[a-z]+", re.sub(r"\\[A-Za-z]", " ", p.pattern.lower()))) | SIGNALS
_STEMS = tuple(w for w in _READ if len(w) > 4)
_RUN = re.compile(r"[^\W_]+")


@lru_cache(1 << 16)
def _shown(word: str) -> str:
    """The word, or a wildcard if no pattern reads it."""
    return word if word in _READ or word.isdigit() or word.startswith(_STEMS) else WILD


def shape(message: str) -> str:
    """The message with wildcards for all words that the verdict doesn't read; its verdict is that of the message."""
    return _RUN.sub(lambda m: _shown(m[0]), message)


def path(tokens: list[str]) -> str:
    """The leaf of a message: number of tokens, first signal words with their places."""
    out = [str(len(tokens))]
    for i, t in enumerate(tokens):
        if t.strip(".,;:…!?¡¿()[]<>/«»\"'") in SIGNALS:
            out.append(f"{i}:{t.strip('.,;:…!?¡¿()[]<>/«»')}")
            if len(out) > DEPTH:
                break
    return " ".join(out)


_MAY_SLOT = re.compile(r"[{$@%\[]|&lt;|<[\w%<]|__\w|#\w+#|:\s*«|\bnull\b|undefined|NaN|None|\bnil\b|\b[Cc]lic|TODO|XXXX|NOMBRE_|POR DEF|\((?:completar|rellenar|agregar|por def)")


def parse(text: str | None) -> tuple[set[str], set[str]]:
    """(messages of a text that have a signal word, kinds of residue seen without templates: slot, filler).

    Messages are in lower case without accents, with single blanks, all digits as 0. What follows an instruction whose object
    goes on to the end of its line is not looked at.
    """
    said: set[str] = set()
    kinds: set[str] = set()
    if not text:
        return said, kinds
    for line, low in zip(text.split("\n"), _plain(text).split("\n")):
        may_slot, whole = _MAY_SLOT.search(line), None
        for j, m in enumerate(messages(low.strip())):
            words = m.encode("utf-8", "replace").translate(_APART).split()
            if not _SIGNALS.isdisjoint(words):
                said.add(" ".join(re.sub(r"\d", "0", m).split()))
            empty = len(words) >= BABBLE and _FUNCTIONS.isdisjoint(words)
            if may_slot or empty:
                whole = whole or messages(line.strip())
                own = whole[j] if j < len(whole) else line
                if may_slot and slot(own):
                    kinds.add("slot")
                elif empty and babble(own.split()):
                    kinds.add("filler")
            if ":" in m and _INTRODUCES.search(m):
                break
    return said, kinds


def judge(text: str | None) -> str | None:
    """Why a text is residue if no template has constants but what the verdict reads: the first of error, filler, script, slot; None if it isn't."""
    said, kinds = parse(text)
    return min(kinds | {k for m in said if (k := verdict(shape(m)))}, default=None)


def _map(df: DataFrame, schema: str, arrow: pa.Schema, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = rows(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * len(arrow.types), arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def signal_messages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, leaf, said, shape): a row for each different message with signal words of a text, and one for each kind seen without templates."""
    arrow = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("leaf", pa.string()), ("said", pa.string()), ("shape", pa.string())])

    def rows(ids: list, texts: list) -> list[tuple]:
        out = []
        for i, t in zip(ids, texts):
            said, kinds = parse(t)
            out += [(i, k, None, None, None) for k in kinds]
            out += [(i, None, path(m.split()), m, shape(m)) for m in said]
        return out

    return _map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull()), "doc_id long, kind string, leaf string, said string, shape string", arrow, rows)


def mine(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages: said, n, template; templates: template, n, verdict), both settled, from a settled table of signal_messages.

    n is the number of documents with the message, summed over the messages of a template. Equal messages are combined within tasks
    before any shuffle. A leaf's constants are at most 1 / CONSTANT for each of its places.
    """
    from telarium.session import settle

    distinct = settle(found.where("said IS NOT NULL").groupBy("leaf", "said", "shape").agg(F.count("*").alias("n")))
    places = distinct.select("leaf", "n", F.posexplode(F.arrays_zip(F.split("said", " ").alias("t"), F.split("shape", " ").alias("s"))).alias("at", "x"))
    seen = places.groupBy("leaf", "at", F.col("x.t").alias("t")).agg(F.sum("n").alias("n"), F.max(F.col("x.t") != F.col("x.s")).alias("open"))
    size = distinct.groupBy("leaf").agg(F.sum("n").alias("all"))
    fixed = seen.where("open AND n > 1").join(size, "leaf").where(F.col("n") >= F.col("all") * CONSTANT).groupBy("leaf").agg(F.collect_set(F.concat_ws(" ", "at", "t")).alias("fixed"))
    token = lambda x, i: F.when(F.array_contains("fixed", F.concat_ws(" ", i.cast("string"), x["t"])), x["t"]).otherwise(x["s"])
    built = F.when(F.col("fixed").isNull(), F.col("shape")).otherwise(F.array_join(F.transform(F.arrays_zip(F.split("said", " ").alias("t"), F.split("shape", " ").alias("s")), token), " "))
    said = settle(distinct.join(fixed, "leaf", "left").select("said", "n", built.alias("template")))
    arrow = pa.schema([("template", pa.string()), ("n", pa.int64()), ("verdict", pa.string())])
    judged = _map(said.groupBy("template").agg(F.sum("n").alias("n")), "template string, n long, verdict string", arrow, lambda ts, ns: [(t, n, verdict(t)) for t, n in zip(ts, ns)])
    return said, settle(judged)


def residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, reason) of the documents that hold residue; of several reasons the first of error, filler, script, slot.

    Null, empty and blank texts are none. Repeated ids come out once. Templates are mined over all rows and judged once, so the
    result is the same however rows are ordered and fall into tasks; only the two named columns are read, texts are read
    whole. Messages in many documents meet their verdict in a broadcast, all others in a join.
    """
    from telarium.operators.joining import lookup
    from telarium.session import settle

    found = settle(signal_messages(docs, id_col, text_col))
    said, judged = mine(found)
    bad = settle(said.join(judged.where("verdict IS NOT NULL").select("template", "verdict"), "template").select("said", "n", "verdict"))
    total = bad.agg(F.sum("n")).first()[0] or 0
    told = lookup(found.where("said IS NOT NULL").select("doc_id", "said"), bad, ["said"], "n", total).select("doc_id", F.col("verdict").alias("kind"))
    return found.where("kind IS NOT NULL").select("doc_id", "kind").unionByName(told).groupBy("doc_id").agg(F.min("kind").alias("reason"))


def templates(docs: DataFrame, text_col: str = "text", min_count: int = 3) -> DataFrame:
    """(template, n, verdict): the message templates of all texts with signal words that ``min_count`` documents or more have."""
    from telarium.session import settle

    return mine(settle(signal_messages(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")))[1].where(F.col("n") >= min_count)
