"""Word lists of the page operators: menu labels and phrases of site furniture in seven languages."""

from __future__ import annotations

#: Entries that shop and magazine menus usually have.
MENU_LABELS: dict[str, str] = {
    "en": "home|shop|store|stores|sale|basket|cart|contact|contact us|about us|help|faq|my account|account|gift cards|new arrivals|journal|blog|news|products|search|menu",
    "de": "startseite|laden|filialen|angebote|warenkorb|kontakt|über uns|hilfe|mein konto|gutscheine|neuheiten|magazin|produkte|suche|aktuelles",
    "nl": "begin|winkel|winkels|aanbiedingen|winkelmand|contact|over ons|hulp|mijn account|cadeaubonnen|nieuw binnen|verhalen|producten|zoeken|nieuws",
    "fr": "accueil|boutique|magasins|soldes|panier|nous écrire|à propos|aide|mon compte|cartes cadeaux|nouveautés|journal|produits|recherche|actualités",
    "es": "inicio|tienda|tiendas|ofertas|cesta|contacto|quiénes somos|ayuda|mi cuenta|tarjetas regalo|novedades|revista|productos|buscar|noticias",
    "pt": "início|loja|lojas|promoções|carrinho|contacto|sobre nós|ajuda|a minha conta|cartões presente|novidades|revista|produtos|procurar|notícias",
    "pl": "strona główna|sklep|salony|wyprzedaż|koszyk|kontakt|o nas|pomoc|moje konto|karty podarunkowe|nowości|magazyn|produkty|szukaj|aktualności",
}

#: Phrases of cookie notices, sign-up, sharing, service, legal and footer lines, teasers and side columns.
FURNITURE: dict[str, str] = {
    "en": """we use cookies|cookie policy|cookie settings|accept all|accept cookies|only necessary|change your choice|files may be saved in your browser|by continuing to browse|store information on your device|manage your options|refuse everything|your privacy matters|privacy settings
sign up for our newsletter|subscribe|your e-mail address|leave your e-mail|off your first order|never miss an offer|write to you twice a month|tell a friend about|points with every purchase
follow us on social|follow us on facebook|share this page|share this article|copy link|print this
skip to main content|skip to content|back to top|search the shop|search the site|log in|register|wish list|your basket
all rights reserved|terms of sale|terms of use|terms and conditions|imprint|privacy policy | privacy | terms|company number|vat registered|trading ltd|prices include vat|exclude delivery costs|errors and changes excepted|we accept cards|payment on account|sitemap|careers|accessibility|delivery costs|our customer service is here|do you need help?
you may also like|popular categories|most read this week|related articles|recently viewed|read more about|by other visitors|mistakes to avoid when buying|the big test of|now choose|reviews of""",
    "de": """wir verwenden cookies|allen zustimmen|ihre auswahl jederzeit ändern|informationen auf ihrem gerät|optionen verwalten|alles unnötige ablehnen|ihre privatsphäre ist uns wichtig|alle annehmen|nur notwendige|durch die weitere nutzung|cookie-richtlinie
für unseren rundbrief|newsletter an|bei der ersten bestellung|abonnieren|ihre e-mail-adresse|kein angebot verpassen|empfehlen sie
folgen sie uns|sozialen netzwerken|seite teilen|link kopieren
zum inhalt springen|nach oben|im laden suchen|anmelden|merkliste
alle rechte vorbehalten|impressum|datenschutz|agb|alle preise enthalten|gesetzliche mehrwertsteuer|zuzüglich versandkosten|irrtümer vorbehalten|wir nehmen karten|kauf auf rechnung|stellenangebote|barrierefreiheit|brauchen sie hilfe?|unser kundendienst ist
das könnte ihnen auch gefallen|beliebte bereiche|diese woche am meisten gelesen|mehr über|fehler beim kauf|der große test|jetzt umsteigen|die man vermeiden kann""",
    "nl": """wij gebruiken cookies|alles toestaan|uw keuze later wijzigen|gegevens op uw apparaat|beheer de opties|weiger alles|uw privacy telt|alleen nodig|cookiebeleid
voor onze nieuwsbrief|korting op de eerste bestelling|inschrijven|uw e-mailadres|mis geen aanbieding|vertel een vriend
volg ons op|sociale media|deel deze pagina|kopieer de link
naar de inhoud|naar boven|zoek in de winkel|inloggen|verlanglijst
alle rechten voorbehouden|colofon|voorwaarden|alle prijzen zijn met btw|zonder verzendkosten|fouten en wijzigingen voorbehouden|wij accepteren|vacatures|toegankelijkheid|retouren|hebt u hulp nodig?|onze klantenservice is
dit vindt u misschien ook leuk|populaire categorieën|deze week het meest gelezen|lees meer over|fouten bij het kopen|de grote test van|nu overstappen|die u kunt voorkomen""",
    "fr": """nous utilisons des cookies|tout accepter|changer votre choix|des informations sur votre appareil|gérer les options|refuser ce qui n'est pas nécessaire|votre vie privée compte|seulement le nécessaire|politique de cookies
inscrivez-vous à notre lettre|de remise sur la première commande|s'abonner|votre adresse | envoyer|ne manquez aucune offre|parlez de
suivez-nous|réseaux sociaux|partager cette page|copier le lien
aller au contenu|haut de page|chercher dans la boutique|connexion|favoris (
tous droits réservés|mentions légales|confidentialité|conditions de vente|les prix sont indiqués|hors frais de livraison|sous réserve d'erreurs|nous acceptons les cartes|plan du site|emplois|accessibilité|besoin d'aide ?|notre service client vous répond
vous aimerez aussi|rayons populaires|les plus lus de la semaine|lire la suite|erreurs à éviter avant un achat|le grand test de|changent d'avis""",
    "es": """utilizamos cookies|puede aceptarlas todas|cambiar su elección|información en su dispositivo|gestione las opciones|rechace lo que no|su privacidad nos importa|aceptar todo|solo lo necesario|política de cookies
suscríbase a nuestro boletín|de descuento en el primer pedido|suscribirse|su correo | enviar|no se pierda ninguna oferta|hable de
síganos en|redes sociales|comparta esta página|copiar enlace
saltar al contenido|volver arriba|buscar en la tienda|lista de deseos|entrar |
todos los derechos reservados|aviso legal|privacidad|condiciones de venta|los precios incluyen impuestos|gastos de envío|salvo error u omisión|aceptamos tarjetas|mapa del sitio|empleo|accesibilidad|devoluciones|¿necesita ayuda?|nuestro servicio de atención responde
también le puede gustar|categorías populares|lo más leído de la semana|leer más sobre|errores que conviene evitar|la gran prueba de|cambian ahora""",
    "pt": """usamos cookies|pode aceitar todos|mudar a sua escolha|informações no seu aparelho|gerir as opções|recusar o que não for|a sua privacidade é importante|aceitar tudo|só o necessário|política de cookies
assine o nosso boletim|de desconto na primeira encomenda|assinar |o seu correio|não perca nenhuma oferta|fale da
siga-nos|redes sociais|partilhe esta página|copiar ligação
saltar para o conteúdo|voltar ao topo|procurar na loja|lista de desejos
todos os direitos reservados|aviso legal|privacidade|condições de venda|os preços incluem impostos|custos de envio|salvo erro ou omissão|aceitamos cartões|mapa do site|empregos|acessibilidade|devoluções|precisa de ajuda?|o nosso apoio ao cliente responde
também pode gostar|categorias populares|os mais lidos da semana|ler mais sobre|erros a evitar na hora|o grande teste de|mudam agora""",
    "pl": """używamy plików cookie|możesz zgodzić się na wszystkie|zmienić wybór|informacje na twoim urządzeniu|zarządzaj opcjami|odrzuć to, co zbędne|twoja prywatność|akceptuję|tylko niezbędne|polityka cookies
zapisz się|naszego newslettera|rabatu na pierwsze zamówienie|twój adres|nie przegap|poleć
obserwuj nas|w sieci|udostępnij tę stronę|kopiuj łącze
przejdź do treści|do góry|szukaj w sklepie|zaloguj|lista życzeń
wszelkie prawa zastrzeżone|nota prawna|prywatność|regulamin|wszystkie ceny zawierają podatek|kosztów dostawy|zastrzegamy możliwość pomyłek|przyjmujemy karty|mapa strony|praca|dostępność|zwroty|potrzebujesz pomocy?|nasz dział obsługi czeka
to może ci się spodobać|popularne kategorie|najczęściej czytane|czytaj więcej|błędów, których można uniknąć|wielki test|zmieniają teraz""",
}

#: More of the same, as sites in general have it.
COMMON: dict[str, str] = {
    "en": """this site uses cookies|uses cookies|use cookies|cookies help us|cookie notice|cookie preferences|manage choices|manage preferences|reject all|decline|agree to our|third-party cookies|personalised ads|show you ads
advertisement|sponsored|advertise with us|promoted|our partners|affiliate links
leave a reply|leave a comment|post a comment|add a comment|your email will not be published|required fields are marked|report abuse|join the discussion|comments are closed
related posts|related stories|related products|recommended for you|more like this|more from|read next|trending now|most popular|most viewed|customers also|people also|also bought|also viewed|others also|older posts|newer posts|previous post|next post|editor's picks|latest news
mailing list|our newsletter|newsletter|email address|e-mail address|get updates|stay in touch|join our|when you join|when you sign up|free e-book|create an account|sign in|sign up|log out|register now|forgot your password|my orders|download our app|get the app
follow us|share on|share this|tweet this|email to a friend|whatsapp|pinterest|instagram|youtube|linkedin
add to cart|add to basket|add to bag|compare|checkout|view cart|item added|free delivery|free shipping|secure payment|day returns|days return|money back|year warranty|track your order|size guide|store finder|find a store|gift wrap
you are here|skip navigation|toggle navigation|open menu|close menu|menu|change country|change language|select language|language:|currency:
terms of service|terms and privacy|data protection|legal notice|site map|press office|copyright|reg. no|registered office|registered in|incl. tax|plus shipping|powered by|contact us|customer service|customer care|call us|call our|opening hours|jobs|without permission""",
    "de": """nutzen cookies|verwendet cookies|cookie-einstellungen|zustimmen|ablehnen|einstellungen verwalten|ihre einwilligung
anzeige|werbung|gesponsert|kommentar schreiben|kommentar hinterlassen|kommentare|mehr zum thema|ähnliche artikel|ähnliche produkte|weitere artikel|meistgelesen|zuletzt angesehen|kunden kauften auch|wird oft zusammen gekauft
newsletter|jetzt registrieren|kostenlos registrieren|keinen beitrag|konto anlegen|passwort vergessen|in den warenkorb|zur kasse|vergleichen|kostenloser versand|versandkostenfrei|sichere zahlung|rückgabe|widerrufsrecht|nutzungsbedingungen|teilen auf|per mail senden|drucken|sie sind hier|menü öffnen|menü|kundenservice|hotline|öffnungszeiten|amtsgericht|ust-id|handelsregister|filialfinder|app herunterladen""",
    "nl": """gebruikt cookies|cookie-instellingen|cookievoorkeuren|akkoord|weigeren|advertentie|gesponsord|reageer|plaats een reactie|reacties|gerelateerde|meer nieuws|anderen bekeken|ook bekeken|vaak samen gekocht|nieuwsbrief|aanmelden|wachtwoord vergessen|wachtwoord vergeten|winkelwagen|vergelijken|gratis verzending|veilig betalen|dagen retour|garantie|deel op|afdrukken|u bent hier|menu|klantenservice|algemene voorwaarden|privacyverklaring|kvk|btw-nummer|download de app""",
    "fr": """utilise des cookies|utilisons des traceurs|personnaliser|refuser|accepter|publicité|sponsorisé|laisser un commentaire|commentaires|articles similaires|à lire aussi|les plus lus|vus récemment|produits similaires|ont aussi acheté|notre newsletter|lettre d'information|je m'inscris|votre e-mail|mot de passe oublié|créer un compte|ajouter au panier|comparer|livraison gratuite|paiement sécurisé|retours|garantie|partager sur|imprimer|envoyer à un ami|vous êtes ici|menu|service client|conditions générales|conditions d'utilisation|qui sommes-nous|recrutement|rcs|télécharger l'application""",
    "es": """usamos cookies|utiliza cookies|cookies propias|configurar|rechazar|aceptar|publicidad|patrocinado|deja un comentario|comentarios|noticias relacionadas|artículos relacionados|productos relacionados|lo más visto|vistos recientemente|también compraron|boletín|regístrate|regístrese|tu correo|olvidó su contraseña|crear una cuenta|añadir al carrito|añadir a la cesta|comparar|envío gratis|pago seguro|garantía|compartir en|enviar por correo|imprimir|estás aquí|está aquí|menú|atención al cliente|condiciones de uso|protección de datos|descarga nuestra|todos los precios""",
    "pt": """usa cookies|utiliza cookies|preferências de cookies|concordo|recusar|aceitar|publicidade|patrocinado|deixe um comentário|comentários|artigos relacionados|notícias relacionadas|produtos relacionados|mais lidas|também viu|também compraram|receba as novidades|subscrever|newsletter|criar conta|esqueceu a senha|adicionar ao carrinho|comparar|entrega grátis|frete grátis|pagamento seguro|trocas|garantia|partilhar no|compartilhar|imprimir|você está aqui|está aqui|menu|apoio ao cliente|fale connosco|termos de uso|política de privacidade|descarregue a""",
    "pl": """używa ciasteczek|używa plików cookie|zgadzam się|odrzuć|ustawienia|reklama|sponsorowane|dodaj komentarz|komentarze|podobne artykuły|podobne produkty|polecamy|najpopularniejsze|ostatnio oglądane|klienci kupili także|newsletter|zarejestruj|załóż konto|nie pamiętasz hasła|dodaj do koszyka|porównaj|darmowa dostawa|bezpieczne płatności|gwarancja|udostępnij na|drukuj|jesteś tutaj|menu|obsługa klienta|warunki korzystania|ochrona danych|polityka prywatności|redakcja|pobierz aplikację|wszelkie prawa""",
}
