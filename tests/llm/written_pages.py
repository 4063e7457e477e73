"""Pages written by hand, none made by the training layouts; of each, the blocks that are main text."""

SAID = (
    "The river rose by two metres during the night, and the lower road was closed before anyone could leave.",
    "Volunteers carried sand from the quarry until the morning; the school served as a shelter for forty families.",
    "According to the mayor, the wall that was built after the last flood held, but the pumps behind it failed.",
    "Nobody was hurt. Insurance companies expect the damage to exceed that of any year since records began.",
    "Engineers will inspect both bridges next week, and trains are to run again as soon as the tracks are dry.",
    "A hydrologist from the university said that such rain used to fall once in a century and now falls every decade.",
    "The council meets on Thursday to decide whether the old meadows should be given back to the river.",
)
REMARKS = (
    "I live on that road and nobody warned us, the sirens were silent the whole night.",
    "Same thing happened when my parents had the bakery there, they lost two ovens and all the flour.",
    "Thanks to everyone who helped!",
    "Why was the money for the pumps spent on the new car park? I would like an answer from the council, not excuses.",
)
TITLE = "Flood reaches the old town"


def p(*texts, tag="p"):
    return "".join(f"<{tag}>{text}</{tag.split()[0]}>" for text in texts)


OBFUSCATED = (
    "<body><div class='xk'><ul><li><a href='/'>Home</a><li><a href='/n'>News</a><li><a href='/s'>Sport</a></ul></div>"
    f"<div class='qzv'><h1>{TITLE}</h1>{p(*SAID)}</div>"
    "<div class='wph'><h3>4 replies</h3>"
    + "".join(f"<div class='tt'><div class='uu'>{who}</div><div class='vv'>3 May 2021</div><p>{text}</p><a href='#r'>Reply</a></div>" for who, text in zip(("anna", "Bert K.", "c_91", "Dora"), REMARKS))
    + "</div><div class='yy'>&copy; 2021 The Valley Post <a href='/i'>Imprint</a></div></body>"
)
DISCUSSION = (
    "<body><header><a href='/'>The Valley Post</a></header><nav><a href='/a'>All</a> <a href='/b'>Local</a></nav>"
    f"<main><h1>{TITLE}</h1>{p(*SAID[:4])}<h2>What happens next</h2>{p(*SAID[4:])}</main>"
    "<div class='discussion'><h2>Discussion</h2>"
    + "".join(f"<div class='entry'><strong>{who}</strong>{p(text)}</div>" for who, text in zip(("Anna", "Bert", "Carl"), REMARKS))
    + "</div><footer>Contact us at the office. All rights reserved.</footer></body>"
)
THREAD = (
    "<body><div id='top'><a href='/'>Home</a> | <a href='/w'>Weather</a></div><div class='wrap'>"
    f"<div class='post-content'><h2>{TITLE}</h2>{p(*SAID)}</div>"
    "<div id='disqus_thread'><ul>"
    + "".join(f"<li><span>{who}</span> <span>2 days ago</span>{p(text)}</li>" for who, text in zip(("Anna", "Bert", "Carl", "Dora"), REMARKS))
    + "</ul></div><aside><h4>Most read</h4><a href='/1'>Bakery closes after ninety years</a></aside></div></body>"
)
FEEDBACK = (
    "<body><div class='bar'><a href='/'>Start</a></div>"
    f"<article><h1>{TITLE}</h1>{p(*SAID)}</article>"
    "<div class='feedback'><h3>Feedback from our readers</h3>"
    + "".join(f"<div><div>{who} wrote on 4 May:</div><div>{text}</div></div>" for who, text in zip(("Anna", "Bert", "Carl", "Dora"), REMARKS))
    + "</div><div class='end'>Printed on recycled paper since 1998</div></body>"
)
PLAIN = (
    "<body><div>We use cookies to improve this site. By reading on you agree to this. <a href='/c'>More</a></div>"
    "<div><a href='/'>Home</a> <a href='/n'>News</a> <a href='/m'>Markets</a></div>"
    f"<div><h1>{TITLE}</h1>{p(*SAID, tag='div')}</div>"
    "<div><a href='/t'>Terms</a> <a href='/p'>Privacy</a> &copy; 2021</div></body>"
)
TABLE = (
    "<body><table><tr><td colspan=2><b>The Valley Post</b> <a href='/'>home</a></td></tr><tr>"
    "<td width=120><a href='/1'>News</a><br><a href='/2'>Sport</a><br><a href='/3'>Letters</a></td>"
    f"<td><h1>{TITLE}</h1>{p(*SAID)}</td></tr><tr><td colspan=2>Copyright 1999 The Valley Post</td></tr></table></body>"
)
WRITTEN = {
    "obfuscated": (OBFUSCATED, [TITLE, *SAID]),
    "discussion": (DISCUSSION, [TITLE, *SAID[:4], "What happens next", *SAID[4:]]),
    "thread": (THREAD, [TITLE, *SAID]),
    "feedback": (FEEDBACK, [TITLE, *SAID]),
    "plain": (PLAIN, [TITLE, *SAID]),
    "table": (TABLE, [TITLE, *SAID]),
}

# Held out: written after the labeller was settled, and not looked at before.
VOICES = (
    "<body><div class='shell'><div class='flank'><h4>Also today</h4>"
    + "".join(f"<div><a href='/{i}'>{text}</a></div>" for i, text in enumerate(("Bakery closes after ninety years", "New bus line to the lake", "Choir sings in the rain")))
    + f"</div><div class='chronicle'><h1>{TITLE}</h1>{p(*SAID[:3])}<blockquote>{p(REMARKS[3])}</blockquote>{p(*SAID[3:])}</div>"
    "<dl class='voices'>"
    + "".join(f"<dt>{who}, 7 June</dt><dd>{text}</dd>" for who, text in zip(("Emil", "Frida", "Gus"), REMARKS))
    + "</dl></div><p>Valley Post Ltd, 12 Mill Lane</p></body>"
)
DIALOG = (
    "<body><div class='strip'>Our office is closed on Monday. Please call the editors instead.</div>"
    f"<section class='a1'><section class='b2'><h1>{TITLE}</h1>{p(*SAID[:4])}<ul><li>Both bridges are closed until Monday.</li>"
    f"<li>Drinking water is handed out at the town hall.</li></ul>{p(*SAID[4:])}</section></section>"
    "<table class='c3'>" + "".join(f"<tr><td>{who}</td><td>{text}</td></tr>" for who, text in zip(("Emil", "Frida", "Gus", "Hanna"), REMARKS)) + "</table>"
    "<div class='d4'><p>This site stores small files on your computer. Do you agree?</p><button>Yes</button> <a href='/no'>Choose</a></div></body>"
)
NESTED = (
    "<body><ul class='r1'><li><a href='/'>Home</a></li><li><a href='/x'>Archive</a></li></ul>"
    f"<div class='r2'><div class='r3'><h2>{TITLE}</h2><div>{p(*SAID, *reversed(SAID[:5]))}</div></div>"
    f"<div class='r4'><p>Said by others</p><div class='r5'><b>Emil</b><p>{REMARKS[0]}</p><div class='r5'><b>Frida</b><p>{REMARKS[1]}</p>"
    f"<div class='r5'><b>Gus</b><p>{REMARKS[2]}</p></div></div></div><div class='r5'><b>Hanna</b><p>{REMARKS[3]}</p></div></div></div>"
    "<div class='r6'>&copy; 2024 <a href='/l'>Legal</a></div></body>"
)
HELD = {
    "voices": (VOICES, [TITLE, *SAID[:3], REMARKS[3], *SAID[3:]]),
    "dialog": (DIALOG, [TITLE, *SAID[:4], "Both bridges are closed until Monday.", "Drinking water is handed out at the town hall.", *SAID[4:]]),
    "nested": (NESTED, [TITLE, *SAID, *reversed(SAID[:5])]),
}
