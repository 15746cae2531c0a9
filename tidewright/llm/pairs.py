"""Broken prompt and response pairs (problem 4): ordered rules, every triggered defect is emitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.language import language_and_script
from tidewright.runtime import latest_by

#: Defects in the order in which one is chosen when several are triggered.
ORDER = ("empty", "copied", "refusal", "truncated", "other_language")

#: Canonical answers that say nothing. Fixed values.
NOTHING = (
    "", "n a", "na", "none", "null", "nil", "nan", "empty", "no answer", "no response", "no reply", "not available", "blank", "tbd", "todo", "undefined",
    "keine antwort", "leer", "nichts", "pas de réponse", "sans réponse", "aucune réponse", "vide", "sin respuesta", "vacío", "ninguna", "无", "空", "暂无", "没有回答", "无回答", "无答案",
)

#: Ways to decline, over text in lower case with single blanks for all other marks ("can't" reads "can t"). Fixed values.
REFUSALS = (
    r"(can ?not|can t|could not|am unable to|m unable to|not able to|won t be able to|will not be able to) (assist|help|provide|answer|respond|do|take|discuss|comply|fulfil|fulfill|share|comment|offer|support|give|engage)",
    r"(must|have to|has to|need to|will|ll|would|d) (decline|refuse|pass on)", r"rather not (respond|answer|say|comment|discuss|get into)", r"\bi (decline|refuse) to\b",
    r"\b(may|must|shall) not (comment|answer|respond|discuss|help|provide|share)", r"not something i (can|could|may|am|m|will)", r"not a (request|question|topic) (that )?i",
    r"outside (of )?what i", r"no comment from", r"no answer can be given", r"(do not|don t|does not|doesn t|never) (answer such|give advice|answer this kind|answer these|answer questions like)",
    r"(instructions|guidelines|rules|policies) do not (permit|allow)", r"goes against my (guidelines|instructions|rules|policies)",
    r"dabei kann ich (leider )?nicht helfen", r"kann ich (dir |ihnen )?(leider )?nicht (helfen|beantworten|weiterhelfen|beantworten|unterstützen)", r"darf ich (leider )?keine auskunft", r"(muss|möchte) (ich )?(das|dies|die anfrage) (leider )?ablehnen",
    r"außerhalb meiner möglichkeiten", r"beantworte ich (grundsätzlich |leider )?nicht", r"kann von mir keine antwort", r"widerspricht meinen (vorgaben|richtlinien)", r"ich lehne (das|die anfrage|diese anfrage) ab",
    r"ne (peux|puis|pourrai|saurais) (malheureusement )?pas (vous|t|te|y)? ?(aider|répondre|fournir|traiter)", r"(dois|préfère|souhaite) (décliner|refuser)", r"préfère ne pas", r"impossible de (vous )?répondre", r"pas une (demande|question) que je", r"dépasse ce que je (peux|puis)",
    r"aucune réponse ne peut", r"consignes ne (me )?le permettent pas", r"je (décline|refuse)\b",
    r"no puedo (ayudar|responder|atender|proporcionar|ofrecer|contestar)", r"no me es posible (responder|ayudar|atender)", r"prefiero no (tratar|responder|hablar|contestar)", r"(debo|tengo que) (rechazar|declinar)", r"fuera de lo que puedo", r"no atiendo (este|esta|ese)",
    r"no se puede dar respuesta", r"normas no (me )?lo permiten", r"(rechazo|declino) (la|esta) (petición|solicitud)",
    r"não (posso|consigo|poderei|me é possível|estou em condições de) (te |lhe |o |a )?(ajudar|ajudá|auxiliar|responder|atender|fornecer|comentar)", r"(devo|preciso|tenho de|tenho que) (recusar|declinar)", r"prefiro não (responder|comentar|tratar|falar)", r"fora do que (eu )?posso",
    r"non (posso|sono in grado di|mi è possibile) (aiutar|rispond|fornir|assister|soddisf|comment)", r"(devo|preferisco) (rifiutare|declinare|non rispondere)",
    r"не (могу|можем|смогу|сможем) (вам |тебе |с этим |вам с этим |на это )?(помочь|ответить|отвечать|предоставить|обсуждать|выполнить|комментировать)", r"(вынужден|вынуждена|должен|должна) отказать", r"отказываюсь (отвечать|выполнять|помогать)", r"не можу (вам |тобі )?(з цим )?(допомогти|відповісти|надати)",
    r"nie mogę (ci |panu |pani |w tym |na to )?(pomóc|odpowiedzieć|udzielić)", r"muszę odmówić", r"kan ik (je |u )?(hier |daar )?(helaas )?niet (mee )?(helpen|beantwoorden)", r"ik kan (je |u |dit |dat |deze vraag )?(hier |daar )?(helaas )?niet (mee )?(helpen|beantwoorden)", r"kan (jag )?(tyvärr )?(inte|ikke) (hjälpa|svara|besvara|hjælpe)",
    r"yardımcı ol(amam|amıyorum|amayacağım)|(cevap|yanıt) veremem|yanıtlayamam",
    r"لا (أستطيع|استطيع|يمكنني|أقدر على) (أن )?(مساعدتك|أساعدك|المساعدة|الإجابة|الرد|تقديم|تلبية)", r"أعتذر عن (الإجابة|المساعدة|عدم)", r"(मदद|सहायता|उत्तर|जवाब) नहीं (कर|दे) सकत", r"tôi không thể (giúp|trả lời|cung cấp|hỗ trợ)", r"tidak (dapat|bisa) (membantu|menjawab|memberikan)",
)
#: The same where words are not set apart by blanks. Fixed values.
REFUSALS_UNSPACED = (
    r"(不便|无法|不能|不可以|难以) ?(回答|回复|提供|处理|满足|帮助|协助|答复|作答)", r"恕 ?(我)? ?(无法|不能|难以)", r"(^| |我|我们|只能|必须|不得不) ?拒绝(回答|该请求|该要求)",
    r"(お答え|回答|お手伝い|ご提供|提供|対応|お応え)(は|を|する)?(こと(は|が))?(でき(ません|ない|かね)|いたしかね|致しかね|出来ません)", r"お断り(し|いたし|致し|させて)", r"(도와 ?드릴|도울|답변 ?드릴|답변할|답할|대답할|제공할|제공해 ?드릴) 수 ?(가 )?없", r"답변을 ?거부",
)
UNSPACED = ("CJK", "HIRAGANA", "HANGUL")
#: A refusal opens the answer: its phrase starts within so many words (characters where words are not set apart), outside
#: of quotation marks.
OPENING_WORDS, OPENING_CHARS = 40, 120
#: Quoted passages: what somebody else said. At least OWN_WORDS words must stand outside of them, else the whole answer counts.
_QUOTED, OWN_WORDS = r"\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|「[^」\n]*」|『[^』\n]*』|‘[^’\n]*’(?!\p{L})|(?<![\p{L}\p{N}])'(?:[^'\n]|'(?=\p{L}))*+'", 3
_MARKUP = r"<[^<>]*>|&nbsp;"

#: A wish for an answer in a named language. Fixed values.
ASKED = (
    r"\b(in|into|auf|ins|en|au|em|para|na|naar|po|til|till) (english|german|french|spanish|chinese|mandarin|russian|portuguese|italian|japanese|korean|arabic|hindi|dutch|polish|turkish|ukrainian|swedish|vietnamese"
    r"|deutsch|englisch|französisch|spanisch|chinesisch|russisch|portugiesisch|italienisch|japanisch|koreanisch|arabisch|anglais|allemand|français|espagnol|chinois|russe|portugais|italien|japonais|coréen|arabe"
    r"|inglés|alemán|francés|español|chino|ruso|portugués|italiano|japonés|coreano|árabe|inglês|alemão|francês|espanhol|chinês|português|inglese|tedesco|francese|spagnolo|cinese|russo|portoghese|giapponese|engels|duits|frans|spaans|nederlands)\b"
    r"|на (английском|немецком|французском|испанском|китайском|русском|японском|английский|немецкий|французский|испанский|китайский|русский)"
    r"|(用|以|译成|翻译成) ?(英|德|法|西班牙|中|汉|俄|日|韩|葡萄牙|阿拉伯|意大利)(文|语)|(英|日本|中国|韓国|ドイツ|フランス|スペイン|ロシア)語で|(영어|한국어|일본어|중국어|독일어|프랑스어|스페인어)로|بال(إنجليزية|عربية|فرنسية|ألمانية|إسبانية|صينية|روسية)"
    r"|\b(translate|translation|übersetze|übersetzung|traduis|traduire|traduce|traducir|traduz|traduza|traduzir|traduci|vertaal|przetłumacz)\b|翻译|翻訳|번역|перевед|ترجم"
)

_FENCE = "```"


def canonical(column: Column) -> Column:
    """Lower case, every run of characters that are neither letters nor digits one blank."""
    return F.trim(F.regexp_replace(F.lower(column), r"[^\p{L}\p{N}\p{M}]+", " "))


def _truncated(answer: Column, words: Column) -> Column:
    """Open code fence, open bracket, or an end in mid-sentence; an ending list or a few plain words are complete."""
    # every pattern is anchored or starts where a run starts, so long runs of blanks or marks stay linear
    text = F.regexp_replace(answer, r"(?<![\s\p{Z}\p{Cf}])[\s\p{Z}\p{Cf}]+$", "")
    lines = F.split(text, "\n")
    last, before = F.element_at(lines, -1), F.coalesce(F.try_element_at(lines, F.lit(-2)), F.lit(""))
    open_fence = (F.size(F.split(text, _FENCE)) % 2) == 0
    open_bracket = text.rlike(r"(?<![:;=8])[(（\[{][^()（）\[\]{}]*$")
    dangling = text.rlike(r"[,;:，；：、(（\[{/\\=&+–—-]$") & (words >= 2)
    bare = text.rlike(r"[\p{L}\p{N}\p{M}]$") & (words > 5)
    marker = r"^[ \t]*(?:[-*•]|\d+[.)])[ \t]"
    item = last.rlike(marker) & ~(before.rlike(marker) & before.rlike(r"[.)）。!?][ \t]*$"))
    return open_fence | open_bracket | dangling | (bare & ~item)


def defects(df: DataFrame, question: Column, answer: Column, context: Column | None = None, keep: dict[str, Column] | None = None) -> DataFrame:
    """``keep`` plus ``defects``: every triggered defect of each pair, in the order of :data:`ORDER`.

    Null or blank answers are ``empty`` and nothing else; a null or blank question can only make an answer ``empty``,
    ``refusal`` or ``truncated``. ``context`` (a system prompt) may also ask for a language. No rule depends on how long an
    answer is: markup is taken off any answer before it is called empty, a refusal may be followed by any explanation (but
    opens the answer, and not as a quotation), and ``other_language`` is a script that the question does not use, or
    another language by function words.
    """
    keep = keep or {}
    base = df.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(question, F.lit("")).alias("_q"), F.coalesce(answer, F.lit("")).alias("_a"), F.coalesce(context if context is not None else F.lit(""), F.lit("")).alias("_s"))
    base = base.select(
        "*",
        canonical(F.col("_q")).alias("_cq"),
        canonical(F.when(F.col("_a").rlike("[<&]"), F.regexp_replace("_a", _MARKUP, " ")).otherwise(F.col("_a"))).alias("_ca"),
    )
    outside = canonical(F.regexp_replace("_a", _QUOTED, " "))
    own = F.when(F.col("_a").rlike("[\"“„«「『‘']") & (F.size(F.split(outside, " ")) >= OWN_WORDS), outside).otherwise(F.col("_ca"))
    base = base.select("*", own.alias("_own"), F.split("_ca", " ").alias("_wa"), F.split("_cq", " ").alias("_wq"), language_and_script(F.col("_q")).alias("_lq"), language_and_script(F.col("_a")).alias("_la"))
    words = F.size("_wa")
    # for the rule on endings each Han character is a word, since no blanks stand between them
    spelled = F.when(F.col("_ca").rlike(r"\p{IsHan}"), F.size(F.regexp_extract_all("_ca", F.lit(r"\p{IsHan}|[^ \p{IsHan}]+"), F.lit(0)))).otherwise(words)
    empty = F.col("_ca").isin(*NOTHING)
    opens = lambda step, phrases: F.col("_own").rlike(f"^{step}?(?:{'|'.join(f'(?:{r})' for r in phrases)})")
    refusal = F.when(F.col("_la.script").isin(*UNSPACED), opens(f".{{0,{OPENING_CHARS}}}", REFUSALS_UNSPACED)).otherwise(opens(f"(?:[^ ]+ ){{0,{OPENING_WORDS}}}", REFUSALS))
    refusal = F.coalesce(refusal, F.lit(False))
    flat_q, flat_a = F.replace("_cq", F.lit(" "), F.lit("")), F.replace("_ca", F.lit(" "), F.lit(""))
    spoken = F.array_distinct("_wa")
    copied = (F.length(flat_q) >= 12) & (
        ((F.length(flat_a) >= 24) & F.contains(flat_q, flat_a))
        | (F.contains(flat_a, flat_q) & (F.length(flat_a) - F.length(flat_q) <= F.greatest(F.lit(48), F.length(flat_q) * 0.25)))
        | ((words >= 8) & (F.size(F.array_intersect(spoken, F.col("_wq"))) >= 0.85 * F.size(spoken)))
    )
    asked = F.lower("_q").rlike(ASKED) | F.lower("_s").rlike(ASKED)
    # a script that the question does not use needs no further words to tell; Latin letters may be names or code
    spoken_other = F.coalesce(F.col("_lq.language") != F.col("_la.language"), F.lit(False))
    written_other = F.coalesce((F.col("_lq.script") != F.col("_la.script")) & (F.col("_la.script") != "LATIN"), F.lit(False))
    other = (spoken_other | written_other) & ~asked
    rules = {"empty": empty, "copied": copied, "refusal": refusal, "truncated": _truncated(F.col("_a"), spelled), "other_language": other}
    listed = F.array_compact(F.array(*[F.when(rules[d], F.lit(d)) for d in ORDER]))
    return base.select(*keep, F.when(empty, F.array(F.lit("empty"))).otherwise(listed).alias("defects"))


def broken_pairs(samples: DataFrame) -> DataFrame:
    """(sample_id, defects, defect): samples whose last user message and ``answer`` form a broken pair.

    Judged are samples with at least one user message; ``defects`` holds every triggered defect and ``defect`` the
    first in :data:`ORDER`. Of each sample_id the latest delivery counts; null ids are dropped.
    """
    user = F.filter("messages", lambda m: F.lower(F.trim(m["role"])) == F.lit("user"))
    asked = samples.select("sample_id", "ingested_at", F.try_element_at(user, F.lit(-1)).alias("_last"), "answer", "system_prompt").where("_last is not null")
    keep = {"sample_id": F.col("sample_id"), "ingested_at": F.col("ingested_at")}
    found = defects(asked, F.col("_last.content"), F.col("answer"), F.col("system_prompt"), keep)
    latest = latest_by(found, "sample_id", "ingested_at", {"defects": F.col("defects")})
    return latest.where(F.size("defects") > 0).select("sample_id", "defects", F.element_at("defects", 1).alias("defect"))
