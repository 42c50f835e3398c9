"""The labelled table: pages written for training, one block per line, ``B`` main body or ``F`` furniture.

A first line with a leading semicolon lists the page's known menu labels. Lines are invented; but for bare menu words, none of
them stands in a table that the operators are tested on.
"""

PAGES = [
    """
; Docs; Pricing; Guides
F Docs | Pricing | Guides | Community | Sign in
F Skip navigation
B Planting beans in a cold spring
B Beans rot in wet soil, so wait until the ground has warmed up and the night frosts are over before you sow the first row.
B Push two seeds into each hole, about as deep as your thumb, and keep the paths between the rows free of weeds until June.
B What you need
B - a hand fork
B - string and six short canes
B We asked four growers how they protect young plants, and all of them still use old curtains on cold nights.
F Advertisement
F Related stories
F Ten tools that every gardener should own
F Why your compost smells and what to do
F Leave a comment
F Your email will not be published. Required fields are marked *
F Get our weekly letter | Email address | Join
F © Green Row Media 2022 · Terms · Privacy · Contact · Advertise with us
""",
    """
F Cookies help us run this site and show you ads that fit. Agree | Manage choices | Reject all
F Home / Recipes / Soups
F Menu
F Search
B Onion soup for six
B Peel the onions and cut them into thin rings, then let them turn golden in butter over a low flame for half an hour.
B Add the stock and a glass of cider, season with thyme, and serve the soup with toasted bread and strong cheese.
B Preparation time 20 minutes
B Readers who tried it with leeks told us that it gets sweeter but loses some of its colour.
F Print recipe | Save | Email to a friend
F More like this
F 12 dinners in under half an hour
F Rate this recipe
F Join 40,000 cooks and get a free e-book when you register
F Follow us: Facebook Instagram Pinterest YouTube
F About the magazine | Jobs | Press office | Cookie notice | Site map
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
""",
    """
; Products; Service; Dealers
F Products Service Dealers Company Blog
F Item added to your cart
F Free delivery on orders over 50 EUR
B The T4 hand saw
B A saw for people who work outdoors all year: the blade is hardened twice and the handle stays warm in winter.
B Length 45 cm
B Weight 380 g
B Both versions can be sharpened at home with an ordinary file, and a short film in the box shows how it is done.
B Products
B Every blade leaves the factory with a number, so that we can tell you years later which steel it was made from.
F Customers also bought
F Recently viewed items
F Add to cart | Compare | Wishlist
F Secure payment · 30-day returns · Two-year warranty
F Questions? Call our service team Mon-Fri 8 am to 6 pm
F Change country | Language: English | Currency: EUR
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
""",
    """
F Accept | Decline
F You are here: Home > News > Local
B Bridge closed until May
B The footbridge behind the station stays closed until May because two beams have to be replaced, the council said.
B Walkers can use the road bridge in the meantime, where the speed limit has been lowered for as long as the works last.
B Residents had asked for lights on the detour, and the first ones will be put up next week.
B Service
B The bus to the upper town runs every ten minutes while the bridge is closed, and it stops at the library as well.
F Share on Facebook | Tweet | WhatsApp
F Read next
F Mayor opens new swimming pool
F Most popular
F Sponsored content
F Download our app
F Newsletter: the day in two minutes, every morning at six
F Terms of service | Data protection | Contact the editors
""",
    """
F Wir und unsere Partner nutzen Cookies für Statistik und Werbung. Zustimmen | Einstellungen | Ablehnen
F Sie sind hier: Start > Ratgeber > Garten
F Menü öffnen
B Bohnen im kalten Frühjahr
B Bohnen faulen in nasser Erde, deshalb sollte man warten, bis der Boden warm ist und es nachts nicht mehr friert.
B Drücken Sie zwei Samen in jedes Loch, etwa daumentief, und halten Sie die Wege bis Juni frei von Unkraut.
B Das wird gebraucht
B Vier Gärtner haben uns erzählt, wie sie junge Pflanzen schützen, und alle nehmen dafür noch immer alte Vorhänge.
F Anzeige
F Mehr zum Thema
F Kommentar schreiben
F Jetzt kostenlos registrieren und keinen Beitrag mehr verpassen
F Teilen auf Facebook | Per Mail senden | Drucken
F Zuletzt angesehen
F Kundenservice | Versand | Rückgabe | Widerrufsrecht | Nutzungsbedingungen
F © 2022 Grünreihe Verlag GmbH, Amtsgericht Musterstadt HRB 1234
""",
    """
; Producten; Klantenservice
F Producten Klantenservice Blog Over het bedrijf
F Gratis verzending vanaf 50 euro
B De handzaag T4
B Een zaag voor mensen die het hele jaar buiten werken: het blad is twee keer gehard en de greep blijft warm.
B Beide uitvoeringen kunnen thuis met een gewone vijl worden geslepen, en een korte film laat zien hoe dat gaat.
B Producten
B Elk blad verlaat de fabriek met een nummer, zodat wij jaren later nog weten van welk staal het is gemaakt.
F Anderen bekeken ook
F In winkelwagen | Vergelijken
F Aanmelden voor de nieuwsbrief | E-mail | Verzenden
F Veilig betalen · 30 dagen retour · Twee jaar garantie
F Algemene voorwaarden | Privacyverklaring | Cookies | Contact
F © 2021 Zaagblad BV, KvK 1234567
""",
    """
F Ce site utilise des cookies pour la mesure d'audience. Accepter | Refuser | Personnaliser
F Vous êtes ici : Accueil > Recettes > Soupes
B Soupe à l'oignon pour six
B Épluchez les oignons et coupez-les en fines rondelles, puis laissez-les dorer dans le beurre à feu doux.
B Ajoutez le bouillon et un verre de cidre, assaisonnez de thym et servez la soupe avec du pain grillé.
B Temps de préparation 20 minutes
F Imprimer | Enregistrer | Envoyer à un ami
F À lire aussi
F Articles similaires
F Publicité
F Laisser un commentaire
F Recevez notre lettre chaque semaine | Votre e-mail | Je m'inscris
F Qui sommes-nous | Recrutement | Presse | Mentions | Plan
F © 2021 Table et Poêle SARL, RCS 123 456
""",
    """
F Usamos cookies propias y de terceros para fines estadísticos. Aceptar | Rechazar | Configurar
F Estás aquí: Inicio > Noticias > Local
B El puente, cerrado hasta mayo
B La pasarela detrás de la estación estará cerrada hasta mayo porque hay que cambiar dos vigas, según el ayuntamiento.
B Los vecinos habían pedido luces en el desvío, y las primeras se instalarán la próxima semana.
B Servicio
B El autobús a la parte alta pasa cada diez minutos mientras dure la obra y para también en la biblioteca.
F Compartir en Facebook | Enviar por correo
F Noticias relacionadas
F Publicidad
F Deja un comentario
F Descarga nuestra aplicación
F Condiciones de uso | Protección de datos | Contacto
""",
    """
F Este site usa cookies para estatística e publicidade. Concordo | Recusar | Preferências
F Produtos Serviço Revendedores Empresa
F Entrega grátis em compras acima de 50 euros
B A serra manual T4
B Uma serra para quem trabalha ao ar livre todo o ano: a lâmina é temperada duas vezes e o cabo fica quente no inverno.
B As duas versões podem ser afiadas em casa com uma lima comum, e um pequeno filme mostra como se faz.
F Adicionar ao carrinho | Comparar
F Quem viu este também viu
F Publicidade
F Receba as novidades | Email | Subscrever
F Pagamento seguro · Trocas em 30 dias
F Termos de uso | Política de privacidade | Fale connosco
""",
    """
F Ta strona używa ciasteczek do celów statystycznych. Zgadzam się | Odrzuć | Ustawienia
F Jesteś tutaj: Start > Porady > Ogród
B Fasola w zimną wiosnę
B Fasola gnije w mokrej ziemi, dlatego lepiej poczekać, aż gleba się ogrzeje i nocne przymrozki miną.
B Czterech ogrodników opowiedziało nam, jak chronią młode rośliny, i wszyscy wciąż używają starych zasłon.
F Reklama
F Podobne artykuły
F Dodaj komentarz
F Udostępnij na Facebooku | Drukuj
F Darmowa dostawa od 200 zł
F Dodaj do koszyka | Porównaj
F Warunki korzystania | Ochrona danych | Redakcja
""",
    """
B A letter to our readers
B Thank you for the many parcels of seeds that reached us after the flood, and for the kind words that came with them.
B Help
B Anyone who lost plants can come to the yard on Saturday, bring a bucket, and take home what grows too thick in our beds.
B Contact
B Write to the office in the old mill if you would like to lend a hand, and please say which days suit you best.
F Reply
F Report abuse
F Older posts
F Newer posts
F Tags: garden, flood, seeds
F Powered by PressHouse
""",
    """
; Chairs; Benches
F Home · Shop · Help · News · Contact
B Chairs
B Oakline 3 – 119.90 EUR
B Oakline 5 – 139.00 EUR
B Birchwood XL – 88.50 EUR
B The chairs are built from boards that have dried for three years in the open, and no two of them look quite alike.
B Benches
B - red
B - blue
B - natural wood
F Home
F Products
F Search
B A bench for the hall should be narrow, so that people can pass, and deep enough to sit on while you take off your boots.
F News
F Blog
B We paint to order. It takes a week.
F Shop / Products / Contact / Menu
F Contact | Home | News | About us | Store
""",
    """
F Suche · Produkte · Aktuelles · Kontakt
B Stühle
B Eichlinie 3 – 119,90 EUR
B Eichlinie 5 – 139,00 EUR
B Die Stühle entstehen aus Brettern, die drei Jahre im Freien getrocknet haben, und keine zwei sehen ganz gleich aus.
F Aktuelles
F Suche
F Warenkorb
B Eine Bank für den Flur sollte schmal sein, damit man vorbeikommt, und tief genug, um sich die Stiefel auszuziehen.
F Produkte
B Bänke
B Wir lackieren auf Bestellung, und das dauert eine Woche, im Winter manchmal auch ein paar Tage länger als im Sommer.
F Kontakt / Suche / Laden / Magazin
""",
    """
F Recherche • Produits • Actualités • Contact
B Chaises
B Chênaie 3 – 119,90 EUR
B Chênaie 5 – 139,00 EUR
B Les chaises sont faites de planches qui ont séché trois ans en plein air, et deux d'entre elles ne se ressemblent jamais.
F Produits
F Actualités
B Un banc pour l'entrée doit être étroit pour qu'on puisse passer, et assez profond pour enlever ses bottes.
F Produits › Recherche › Contact › Accueil
""",
    """
B Sillas
B Robledo 3 – 119,90 EUR
B Las sillas se hacen con tablas que se han secado tres años al aire libre, y no hay dos que sean del todo iguales.
F Noticias
F Buscar
B Un banco para la entrada debe ser estrecho para que se pueda pasar, y lo bastante hondo para quitarse las botas.
F Productos   Noticias   Buscar   Ayuda
""",
    """
B Krzesła
B Dębowe 3 – 119,90 zł
B Krzesła powstają z desek, które schły trzy lata na powietrzu, i nie ma dwóch zupełnie takich samych.
F Produkty
F Szukaj
F Aktualności
B Ławka do przedpokoju powinna być wąska, żeby dało się przejść, i dość głęboka, żeby zdjąć buty.
F Produkty | Szukaj | Aktualności | Kontakt
""",
    """
; Home; Sale; Shop; Basket; Materials
F Skip navigation
F Home
F Shop
F Sale
F Basket
F My account
F Contact
B Planting beans in a cold spring
B The new frames are welded by hand in our own workshop, and every joint is checked twice before it is painted.
B We looked at 12 makers before we decided who should sew our tents. They now work three days a week for us alone.
B Gift cards
B A gift card never expires here, and the person who gets it can spend it in one go or in many small steps.
B Our oat cookies are baked every morning, and this week we use dark chocolate in all of them.
B In this guide we explain what a privacy policy should contain and why we rewrote our own last year.
B Ferrono S – 31.50 EUR
B Ferrono M – 35.50 EUR
F Advertisement
F 7 mistakes to avoid when buying tents
F Read more about tents »
F 31 reviews of tents by other visitors
F Why long-distance walkers now choose tents
F tents: the big test of 2024
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F Docs | Pricing | Guides | Community | Sign in
F © 2024 Ferrono. All rights reserved. Imprint | Privacy | Terms of sale
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
""",
    """
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F Home | Shop | Sale | Journal | Help | Contact
F Home > Journal > Nordwal
B What you need
B What started as a stall on the market has become a shop with two floors and a workshop in the yard behind it.
B About us
B People who come back after years often tell us that the smell of wood and wax is still the same as then.
F Related stories
B Readers often ask how to follow a trail at night; follow us on this short walk and you will see for yourself.
B The menu of the evening changes with the market: soup first, then fish, and a plum cake at the end of it.
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
B If you are not happy with your desk lamp, write to us and we will find an answer within 20 hours.
F Why your compost smells and what to do
F Ten tools that every gardener should own
F Leave a comment
F Home / Recipes / Soups
F Menu
F Tell a friend about Nordwal and collect 20 points with every purchase.
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F Your email will not be published. Required fields are marked *
F Nordwal Trading Ltd, Unit 3, Mill Lane. Company number 20031. VAT registered.
F Search
""",
    """
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
F Gift cards New arrivals Stores Help About us
F Get our weekly letter | Email address | Join
B - a hand fork
B A careful browser window hides the monthly table, and old targets of the export file confuse the client team.
B - string and six short canes
B Nobody needs 40 different lamps, and that is why we only keep the ones we use ourselves.
F More like this
F By continuing to browse Lumo you agree that small files may be saved in your browser. Read our cookie policy.
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
B Onion soup for six
B Sale
B Late records of the price list attract typed addresses before the weekly export. Parked pages explain nothing.
B Beans rot in wet soil, so wait until the ground has warmed up and the night frosts are over before you sow the first row.
F Home
F Stores
F Journal
""",
    """
B Push two seeds into each hole, about as deep as your thumb, and keep the paths between the rows free of weeds until June.
""",
    """
F Help Contact Shop Home
B We asked four growers how they protect young plants, and all of them still use old curtains on cold nights.
B Peel the onions and cut them into thin rings, then let them turn golden in butter over a low flame for half an hour.
F 12 dinners in under half an hour
""",
    """
B Preparation time 20 minutes
B Lamps
B The new lamp weighs less than the old one.
B Tables
B The T4 hand saw
B A short text that stands on a page without any menu or footer, just as it was written years ago.
""",
    """
; Laden; Kontakt; Größen
F Menü öffnen
F Startseite › Laden › Angebote › Kontakt › Hilfe
F Startseite
F Laden
F Angebote
F Kontakt
B Bohnen im kalten Frühjahr
B Die neuen Rahmen werden in unserer Werkstatt von Hand geschweißt, und jede Naht wird zweimal geprüft.
B Gutscheine
B Bohnen faulen in nasser Erde, deshalb sollte man warten, bis der Boden warm ist und es nachts nicht mehr friert.
B Unsere Haferkekse werden jeden Morgen frisch gebacken, und diese Woche nehmen wir dunkle Schokolade dazu.
F Anzeige
F Mehr zum Thema
F Kommentar schreiben
F Zuletzt angesehen
F Wir und unsere Partner nutzen Cookies für Statistik und Werbung. Zustimmen | Einstellungen | Ablehnen
F Mehr über Lampen lesen »
F Lampen: der große Test 2024
F Suche · Produkte · Aktuelles · Kontakt
F Aktuelles
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F © 2023 Nordwal. Alle Rechte vorbehalten. Impressum | Datenschutz | AGB
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
""",
    """
F Winkel  Over ons  Hulp  Aanbiedingen  Contact
F Producten Klantenservice Blog Over het bedrijf
B De handzaag T4
B Niemand heeft veertig verschillende lampen nodig, en daarom houden we alleen wat we zelf graag gebruiken.
B Winkel
B Het verhaal van Nordwal is ook het verhaal van de mensen die naaien, lijmen en inpakken in de oude haven.
F Gratis verzending vanaf 50 euro
F Lees meer over lampen »
F lampen: de grote test van 2024
F Anderen bekeken ook
F Aanmelden voor de nieuwsbrief | E-mail | Verzenden
F In winkelwagen | Vergelijken
F © 2021 Zaagblad BV, KvK 1234567
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
""",
    """
F À propos > Journal > Nordwal
F Accueil · Boutique · Panier · Aide
B Soupe à l'oignon pour six
B Personne n'a besoin de 40 modèles, et c'est pourquoi nous ne gardons que ceux que nous aimons vraiment.
B Ce qui a débuté avec 46 commandes par mois est devenu le plus grand choix que nous ayons jamais eu.
B Soldes
B L'histoire de la maison est aussi celle des personnes qui cousent, collent et emballent à la main.
F À lire aussi
F Lire la suite sur les lampes »
F Ce site utilise des cookies pour la mesure d'audience. Accepter | Refuser | Personnaliser
F Articles similaires
F Publicité
F Laisser un commentaire
F Recherche • Produits • Actualités • Contact
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
F Vous êtes ici : Accueil > Recettes > Soupes
""",
    """
; Tienda; Ayuda; Contacto
F Inicio / Tienda / Ofertas / Ayuda / Contacto
F Inicio
F Tienda
F Ofertas
B El puente, cerrado hasta mayo
B Nadie necesita 40 modelos distintos, y por eso solo guardamos los que nosotros mismos usamos cada día.
B Revista
B Si no está contento con su pedido, escríbanos y le responderemos en menos de 20 horas, también en verano.
F Estás aquí: Inicio > Noticias > Local
F Compartir en Facebook | Enviar por correo
F Noticias relacionadas
F Publicidad
F Leer más sobre lámparas »
F lámparas: la gran prueba de 2024
F Deja un comentario
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
F Usamos cookies propias y de terceros para fines estadísticos. Aceptar | Rechazar | Configurar
""",
    """
F Sklep | O nas | Pomoc | Kontakt | Koszyk
F Sklep
F Salony
F Pomoc
B Fasola w zimną wiosnę
B Nikt nie potrzebuje 40 różnych modeli, dlatego zostawiamy tylko te, których sami używamy na co dzień.
B Nowości
B Historia naszej firmy to także historia ludzi, którzy szyją, kleją i pakują ręcznie w starym porcie.
F Jesteś tutaj: Start > Porady > Ogród
F Czytaj więcej: lampki »
F lampki: wielki test 2024
F Reklama
F Podobne artykuły
F Dodaj komentarz
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
""",
    """
F Contacto • Loja • Revista • Ajuda
B A serra manual T4
B Uma serra para quem trabalha ao ar livre todo o ano: a lâmina é temperada duas vezes e o cabo fica quente no inverno.
B Promoções
B A história da casa é também a das pessoas que costuram, colam e embalam à mão junto ao porto velho.
F Produtos Serviço Revendedores Empresa
F Adicionar ao carrinho | Comparar
F Ler mais sobre luminárias »
F Este site usa cookies para estatística e publicidade. Concordo | Recusar | Preferências
F Quem viu este também viu
F Publicidade
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
""",
    """
F Home
F Basket
F Journal
B The old frames were welded by hand, and every joint was checked twice before it was painted and sent to the shop in town.
B Stores
B Our second shop opened in spring next to the old harbour, and on Saturdays you can try every tent in the yard behind it.
F Rate this recipe
B People who bought a tent here often tell us that the colour was the reason, and that the zip still works after ten years.
F Help | Stores | Sale | My account
B The second workshop moved to a larger hall in autumn, because the old one had no room left for the new sewing machines.
F Stores Help My account New arrivals
B Nobody needs forty tents, and that is why we only keep the ones that we use ourselves on every weekend of the year.
F Contact
F Gift cards
B A long winter is a good time to mend what broke in summer, and our small team is happy to help with every seam and zip.
""",
    """
F Home > Company > Nordwal
B The catalogue is printed on thick paper, and a copy can be ordered free of charge by everyone who lives in the region.
F Laden · Hilfe · Angebote
B Was mit einem Stand auf dem Markt anfing, ist heute ein Laden mit zwei Stockwerken und einer Werkstatt im Hof dahinter.
F Warenkorb (2): 18.00 EUR
B Die neue Werkstatt liegt neben dem alten Hafen, und am Samstag kann man dort jedes Zelt im Hof dahinter ausprobieren.
F Hilfe
F Filialen
B Wer lange sucht, findet bei uns auch Ersatzteile, die sonst niemand mehr führt, und das seit mehr als zwanzig Jahren.
F Nordwal Trading Ltd, Unit 9, Mill Lane. Company number 104. VAT registered.
B Ein langer Winter ist die beste Zeit, um zu reparieren, was im Sommer kaputtging, und unser Team hilft gern dabei mit.
F © Green Row Media 2022 · Terms · Privacy · Contact · Advertise with us
B A letter from a reader in the north reached us last week, and we would like to answer it here for everybody who asked.
""",
    """
B The oldest lamp in our house still burns, and nobody remembers who brought it here or when it was repaired for the first time.
B Help
F Follow us: Facebook Instagram Pinterest YouTube
B Every autumn the team walks along the river and collects what the water leaves behind, from rope and wood to old glass.
B Sale
F Registered office: 4 Dock Road. Reg. no. 554433. All prices incl. tax, plus shipping.
F Copyright 2021 Table & Pan Ltd. Reproduction without permission is prohibited.
B Stores
B Every lamp is checked by hand.
B Journal
B The bees are back.
B About us
F Products Service Dealers Company Blog
F Read more about lamps »
F A minha conta
F Loja
B Esta casa fica junto ao porto velho, e quem chega de barco vê primeiro a luz da janela do segundo andar e depois a rua.
F A minha conta
F Contacto
B Quem procura peças antigas encontra aqui muito do que já ninguém vende, e isso há mais de vinte anos na mesma rua.
F Strona główna
F O nas
B Kto długo szuka, znajdzie u nas także części, których nikt inny już nie ma, i to od ponad dwudziestu lat na tej ulicy.
B Promoções
F Item added to your cart
F Free delivery on orders over 50 EUR
F © 2024 Nordwal. All rights reserved. Imprint | Privacy | Terms of sale
""",
    """
B Im Herbst zieht das ganze Dorf an den Fluss und sammelt ein, was das Wasser übrig lässt, von Seilen und Holz bis zu Glas.
B Gutscheine
F Customers also bought
B Wer lange sucht, findet hier auch Teile, die sonst niemand mehr führt, und das seit über zwanzig Jahren in dieser Straße.
B Hilfe
F Impressum
B In the evening the whole street smells of bread, and people who work late can still buy a loaf at the back door for less.
B Sale
F Newsletter
F Recently viewed items
F Home
F Sale
F Help
B Length 45 cm
B Gift cards
B Weight 380 g
""",
]
