"""Hand-labelled pages from which the HTML model learns what the corpus may not show.

Elements with the attribute ``data-main`` belong to the article, those inside them too unless they carry
``data-other``. The attribute is no input of the model.
"""

_STORY = "The council met on Tuesday and agreed, after a long debate, to rebuild the old bridge. "
_NOTE = "Work starts in spring, the mayor said, and will take two years to finish. "
_SHORT = "Read more"
_LINKS = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("home", "news", "sport", "about"))

LABELLED_PAGES = (
    f"""<html><body><header><h2>The Daily</h2></header><nav><ul>{_LINKS}</ul></nav>
<main data-main><article><h1>Bridge</h1><p>{_STORY * 3}</p><p>{_NOTE * 2}</p>
<aside data-other><h3>Related</h3><ul>{_LINKS}</ul></aside><p>{_STORY}</p></article></main>
<footer>&copy; The Daily <a href="/terms">Terms</a></footer></body></html>""",
    f"""<html><body><div class="menu"><ul>{_LINKS}</ul></div><div id="content" data-main><h1>Bridge</h1>
<div class="entry-content"><p>{_STORY * 2}</p><h2>When</h2><p>{_NOTE * 3}</p><blockquote><p>{_NOTE}</p>
</blockquote></div><div class="comments" data-other><h3>Comments</h3><div class="comment"><p>{_NOTE}</p></div>
<form><textarea>Say</textarea><button>Send</button></form></div></div>
<div class="sidebar"><div class="widget"><h3>Popular</h3><ul>{_LINKS}</ul></div><p>{_NOTE}</p></div>
<div id="footer"><p>All content of The Daily, all years.</p></div></body></html>""",
    f"""<html><body><div class="cookie-notice"><p>We use cookies to make this site work for you.</p>
<button>Accept</button></div><div class="wrapper" data-main><div class="header" data-other><a href="/">Daily</a>
</div><div class="post"><h1>Bridge</h1><p>{_STORY * 4}</p><div class="ad" data-other><p>{_NOTE}</p></div>
<ul><li>{_STORY}</li><li>{_NOTE}</li></ul><p>{_NOTE * 2}</p><table><tr><th>Year</th><td>Cost in all</td></tr>
</table><div class="share" data-other><a href="#">Share</a> <a href="#">Send</a></div></div></div>
<div class="newsletter"><form><p>Get the news by mail every day.</p><input></form></div></body></html>""",
    f"""<html><body><section class="story" data-main><h1>Bridge</h1><section><h2>Why</h2><p>{_STORY * 2}</p>
<pre>a = b</pre></section><section><h2>How</h2><p>{_NOTE * 2}</p><figure><figcaption>{_NOTE}</figcaption>
</figure></section></section><section class="related"><h2>More</h2><p><a href="/x">{_SHORT}</a></p></section>
<section id="comments"><h2>Two comments</h2><p>{_STORY}</p><p>{_NOTE}</p></section>
<div class="advert"><p>{_NOTE}</p></div><div class="notice"><p>{_SHORT} before you go on.</p></div></body></html>""",
    f"""<html><body><table><tr><td class="nav"><a href="/">Home</a><a href="/n">News</a></td><td class="text"
data-main><h1>Bridge</h1><p>{_STORY * 2}</p>{_NOTE * 3}<p>{_STORY}</p></td><td class="banner"><p>{_NOTE}</p>
</td></tr></table><div class="copyright"><p>The Daily, all rights.</p></div></body></html>""",
    f"""<html><body><aside class="sidebar"><h3>Topics</h3><ul>{_LINKS}</ul><p>{_STORY}</p></aside>
<div class="main" data-main><h1>Bridge</h1><div><div><p>{_STORY * 2}</p><div>{_NOTE * 2}</div></div></div></div>
<div class="reader-comments"><ol><li><p>{_STORY}</p></li><li><p>{_NOTE}</p></li></ol></div>
<form class="login"><label>Name</label><input><label>Word</label></form><div class="alert"><p>{_NOTE}</p></div>
<footer><p>{_NOTE}</p></footer></body></html>""",
)
