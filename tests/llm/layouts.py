"""Pages of hand-laid layouts with the text of their articles; none comes from the generator."""

P=["The council met on Tuesday evening to discuss the new plan for the harbour and the roads around it.",
"Several residents spoke against the plan, saying that the traffic would double within only two years.",
"The mayor answered that studies had been made, and that their results would be published before the vote.",
"A second meeting is planned for the end of the month, when the engineers will present their drawings.",
"Until then the old regulations stay in force, and nothing will be built along the eastern shore."]
MENU='<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
FOOT='&copy; 2024 Harbour Gazette. All rights reserved.'
ps=lambda xs=P: "".join(f"<p>{x}</p>" for x in xs)
nav=f"<nav>{MENU}</nav>"; dnav=f"<div>{MENU}</div>"; foot=f"<footer>{FOOT}</footer>"; dfoot=f"<div>{FOOT}</div>"
T="Harbour plan divides the town"
def wrap(x): return f"<!DOCTYPE html><html><head><title>x</title></head><body>{x}</body></html>"
L={}
def add(name, html, want): L[name]=(wrap(html), want)
for c in ['<div class="entry">|</div>','<div class="single">|</div>','<div>|</div>','<section>|</section>','<table><tr><td>|</td></tr></table>','<div class="body-copy prose">|</div>','<div id="mw-content-text">|</div>','<div class="zqx-17">|</div>','<div><div><div>|</div></div></div>','<center>|</center>','<main>|</main>','<article>|</article>','<div class="td-ss-main-content"><div class="wpb_wrapper">|</div></div>','|','<div itemprop="articleBody">|</div>','<font size=3>|</font>']:
    a,b=c.split('|')
    add('menu+foot '+c, nav+a+f"<h1>{T}</h1>"+ps()+b+foot, [T,*P])
add('unnamed all', dnav+f"<div><h1>{T}</h1>{ps()}</div>"+dfoot, [T,*P])
add('layout table', f"<table><tr><td>{MENU}</td><td><h2>{T}</h2>{ps()}</td><td><p><a href=/a>Other story of today</a></p><p><a href=/b>Yet another one</a></p></td></tr></table><p>{FOOT}</p>", [T,*P])
add('divs as paragraphs', nav+"<div class=copy>"+"".join(f"<div>{x}</div>" for x in P)+"</div>"+foot, P)
add('unclosed paragraphs', nav+"<div>"+"".join(f"<p>{x}" for x in P)+"</div>"+foot, P)
add('br text', nav+"<div>"+"<br><br>".join(P)+"</div>"+foot, [" ".join(P)])
add('headings', nav+f"<div><h1>{T}</h1><h2>Background</h2><p>{P[0]}</p><p>{P[1]}</p><h2>What comes next</h2><p>{P[2]}</p><p>{P[3]}</p></div>"+foot, [T,"Background",P[0],P[1],"What comes next",P[2],P[3]])
add('list', nav+f"<div><p>{P[0]}</p><ul><li>A wider road</li><li>Two new bridges for the town</li><li>A pier</li></ul><p>{P[1]}</p><p>{P[2]}</p></div>"+foot, [P[0],"A wider road","Two new bridges for the town","A pier",P[1],P[2]])
add('code', nav+f"<div><p>{P[0]}</p><pre><code>make harbour --all</code></pre><p>{P[1]}</p><p>{P[2]}</p></div>"+foot,[P[0],"make harbour --all",P[1],P[2]])
add('caption', nav+f"<section><p>{P[0]}</p><figure><img src=a><figcaption>The harbour in May</figcaption></figure><p>{P[1]}</p><p>{P[2]}</p></section>"+foot,[P[0],"The harbour in May",P[1],P[2]])
add('quote', nav+f"<div class=x1><p>{P[0]}</p><blockquote><p>{P[1]}</p></blockquote><p>{P[2]}</p></div>"+foot,P[:3])
add('comments named', nav+f"<div><h1>{T}</h1>{ps()}</div><div class=comments><div class=comment><p>I do not believe a word of what the mayor said there.</p></div><div class=comment><p>Nice article, thank you for it.</p></div></div>"+foot,[T,*P])
add('comment list', nav+f"<div class=single>{ps()}</div><h3>2 Comments</h3><ol class=commentlist><li><p>I do not believe a word of it.</p></li><li><p>Me neither, to be honest with you all.</p></li></ol>"+foot,P)
add('cookie + form', f"<div id=cookie-banner><p>We use cookies to make this site better for you. By going on you agree.</p></div>"+nav+f"<div>{ps()}</div><form><label>Your mail</label><input><p>Get our letter every week.</p><button>Sign up</button></form>"+foot,P)
add('side', nav+f"<div class=left><h1>{T}</h1>{ps()}</div><div class=right><h3>Most read</h3><ul><li><a href=/1>Storm hits coast</a></li><li><a href=/2>School opens again</a></li></ul></div>"+foot,[T,*P])
add('ad within', nav+f"<div><p>{P[0]}</p><p>{P[1]}</p><div class=advertisement>Buy the new phone today and save a lot.</div><p>{P[2]}</p><p>{P[3]}</p></div>"+foot,P[:4])
add('share within', nav+f"<div><h1>{T}</h1><div class=share-buttons><a href=/f>Share</a> <a href=/t>Tweet</a></div>{ps()}</div>"+foot,[T,*P])
add('unclosed video', nav+f"<div><p>{P[0]}</p><video src=a><p>{P[1]}</p><select><p>{P[2]}</p></div>"+foot,P[:3])
add('unclosed svg object', nav+f"<article><p>{P[0]}</p><svg><path d=x><p>{P[1]}</p><object data=y><p>{P[2]}</p></article>"+foot,P[:3])
add('closed video', nav+f"<div><p>{P[0]}</p><video src=a>No video here, sorry for that.</video><p>{P[1]}</p><p>{P[2]}</p></div>"+foot,P[:3])
add('sections', nav+f"<div>"+"".join(f"<section><h2>Part {i}</h2><p>{a}</p><p>{b}</p></section>" for i,(a,b) in enumerate([(P[0],P[1]),(P[2],P[3])]))+"</div>"+foot,["Part 0",P[0],P[1],"Part 1",P[2],P[3]])
add('one paragraph', nav+f"<div class=q><h1>{T}</h1><p>{P[0]} {P[1]} {P[2]}</p></div>"+foot,[T," ".join(P[:3])])
add('header in article', f"<header><a href=/>Gazette</a></header><div class=story-wrap><header><h1>{T}</h1></header>{ps()}</div>"+foot,[T,*P])
add('data table', nav+f"<div><p>{P[0]}</p><p>{P[1]}</p><table><tr><td>Length</td><td>200 m</td></tr><tr><td>Cost</td><td>4 million</td></tr></table><p>{P[2]}</p></div>"+foot,[P[0],P[1],"Length","200 m","Cost","4 million",P[2]])
add('links in text', nav+"<div>"+"".join(f'<p>{x} <a href=/z>More on this</a> can be read there.</p>' for x in P)+"</div>"+foot,[f"{x} More on this can be read there." for x in P])
add('pagination', nav+f"<div>{ps()}<div class=pagination><a href=/1>1</a> <a href=/2>2</a> <a href=/3>Next</a></div></div>"+foot,P)
