"""Pages written by hand, each with its main text: they share no code and no wording with the training pages."""

PAGES = [
    ("<html><body><div id=top><a href=/>Home</a> | <a href=/a>About</a></div><article><h1>Rain returns</h1><p>It rained on Monday.</p><p>Farmers were pleased, and so were the frogs.</p></article><footer>Copyright 2020</footer></body></html>",
     ["Rain returns", "It rained on Monday.", "Farmers were pleased, and so were the frogs."]),
    ("<body><article><h2>Soup</h2><div class='notice'><p>Careful: cookies.</p></div><ul><li>one onion</li><li>two carrots</li></ul></article></body>",
     ["Soup", "one onion", "two carrots"]),
    ("<nav class=menu><ul><li><a href=1>News</a><li><a href=2>Sport</a></ul></nav><main><h1>Cup final</h1><p>The home side won by two goals in front of a large crowd.<p>Nobody was hurt.</main><aside><h3>Popular</h3><ul><li><a href=x>Ten best hats</a></ul></aside>",
     ["Cup final", "The home side won by two goals in front of a large crowd.", "Nobody was hurt."]),
    ("<div id=page><div class=header><h1>My blog</h1></div><div class=post><h2>A walk</h2><p>We walked <em>all</em> day &amp; slept well.</p><blockquote>Walk on, he said.</blockquote></div><div class=sidebar><h4>Archive</h4><ul><li><a href=a>May</a></li><li><a href=b>June</a></li></ul></div></div>",
     ["A walk", "We walked all day & slept well.", "Walk on, he said."]),
    ("<article><h1>Tides</h1><p>The moon pulls the sea.</p><aside class=related><h3>Read next</h3><ul><li><a href=q>Stars</a></li><li><a href=r>Planets</a></li></ul></aside><p>Twice a day the water rises.</p></article>",
     ["Tides", "The moon pulls the sea.", "Twice a day the water rises."]),
    ("<header class=site-header><a href=/>Logo</a><nav><a href=1>One</a><a href=2>Two</a></nav></header><article><p>Only one paragraph is here, of some length, about nothing at all.</p></article><div class=comments><h3>2 comments</h3><div class=comment><p>Ann</p><p>I liked this very much.</p></div><div class=comment><p>Bob</p><p>I did not.</p></div></div>",
     ["Only one paragraph is here, of some length, about nothing at all."]),
    ("<div class='ad-banner'>Buy now! Half price!</div><div class=content><h1>Bread</h1><ol><li>Mix the flour and the water.</li><li>Wait an hour.</li><li>Bake it.</li></ol><p>Serve warm.</p></div><div class=footer>All rights reserved.</div>",
     ["Bread", "Mix the flour and the water.", "Wait an hour.", "Bake it.", "Serve warm."]),
    ("<article><header><h1>Inside header</h1><p>By A. Writer</p></header><p>The text itself begins here, after the header of the article.</p><footer>Filed under: news</footer></article>",
     ["The text itself begins here, after the header of the article."]),
    ("<article><h1>Numbers</h1><table><tr><th>Year</th><th>Sum</th></tr><tr><td>1999</td><td>12</td></tr></table><pre>x = 1</pre></article><form class=search><label>Search</label><input name=q><button>Go</button></form>",
     ["Numbers", "Year", "Sum", "1999", "12", "x = 1"]),
    ("<div class=cookie-banner><p>This site uses cookies to make it better.</p><button>Accept</button></div><article><h1>Cheese</h1><p>Milk is warmed, and then it is left alone for a night.</p></article>",
     ["Cheese", "Milk is warmed, and then it is left alone for a night."]),
    ("<main><article><h1>Long story</h1><p>First part.</p><div class='advert'>Try our new car today.</div><p>Second part of it.</p><form class=newsletter><label>Your mail</label><button>Subscribe</button></form><p>Third and last part.</p></article></main>",
     ["Long story", "First part.", "Second part of it.", "Third and last part."]),
    ("<body><div class=breadcrumb><a href=1>Start</a> <a href=2>Here</a></div><div class=entry><h1>Knots</h1><h2>Reef</h2><p>Left over right.</p><h2>Bowline</h2><p>The rabbit comes out of the hole.</p></div><div class=pagination><a href=3>Next</a></div></body>",
     ["Knots", "Reef", "Left over right.", "Bowline", "The rabbit comes out of the hole."]),
    ("<body><script>var a = '<p>no</p>';</script><style>p { color: red }</style><article><p>Seen &mdash; and &quot;heard&quot;.</p><noscript>Turn scripts on</noscript></article></body>",
     ["Seen — and \"heard\"."]),
    ("<article><p>Line one<br>line two</p><p>   spaced \n\t out   words </p></article>",
     ["Line one line two", "spaced out words"]),
    ("<nav><a href=a>A</a></nav><footer><p>Imprint</p></footer>", []),
    ("<article><h1>Signals</h1><p>See the <a href=x>first</a>, the <a href=y>second</a> and the <a href=z>third</a> of the reports on this.</p></article><menu><li><a href=1>Up</a></li></menu>",
     ["Signals", "See the first, the second and the third of the reports on this."]),
    ("<div class=wrapper><div class=top-bar>Call us: 123</div><section class=article><h1>Bees</h1><p>Bees dance to tell others where flowers are.</p><dl><dt>Drone</dt><dd>A male bee.</dd></dl></section><div class=widget><h4>Tags</h4><a href=1>bees</a></div></div>",
     ["Bees", "Bees dance to tell others where flowers are.", "Drone", "A male bee."]),
    ("<article><div><div><p>Nested deep, but still the article's own text.</p></div></div></article><div class='social share'><a href=1>Tweet</a><a href=2>Mail</a></div>",
     ["Nested deep, but still the article's own text."]),
    ("<article><h1>Ferry</h1><section class=comments><h3>Readers say</h3><p>I was there too.</p></section><p>The ferry leaves at nine.</p></article>",
     ["Ferry", "The ferry leaves at nine."]),
    ("<article><h1>Words</h1><ul><li>short</li><li>shorter</li></ul><p>End</p></article><aside>Advertisement: learn to dance in three days!</aside>",
     ["Words", "short", "shorter", "End"]),
    ("<article><h1>Storm</h1><div class='alert'>Roads are closed. Stay at home.</div><p>The storm came from the west.</p><div class='alert'><p>Call this number.</p></div><ol><li>Close the windows.</li><li>Wait.</li></ol></article>",
     ["Storm", "The storm came from the west.", "Close the windows.", "Wait."]),
    ("<header><h1>The Daily</h1></header><article><h1>Ships</h1><figure><img src=x><figcaption>A ship at sea</figcaption></figure><p>Ships carry most goods.</p></article><footer><ul><li><a href=1>Terms</a></li><li><a href=2>Privacy</a></li></ul></footer>",
     ["Ships", "A ship at sea", "Ships carry most goods."]),
    ("<div class=sidebar><p>About me: I write things, and this is a long enough text about it. It goes on for a while.</p></div><article><p>Short.</p></article>",
     ["Short."]),
    ("<article lang=fr><h1>Été</h1><p>Il fait très chaud, et l’on dort mal.</p><svg class=i/><p>Demain, la pluie.</p></article>",
     ["Été", "Il fait très chaud, et l’on dort mal.", "Demain, la pluie."]),
]
